"""Alignment of two tokenizers against offsets counted byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from llm_fixtures import odd_documents, without_rows
from tokenizers import Tokenizer

from lexmill.llm import alignment
from lexmill.llm.alignment import _bytes_50k, _pieces_32k


def plain_bytes_of():
    """Byte of each letter in which a byte-level BPE writes its tokens."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for b in range(256):
        if b not in plain:
            out[chr(256 + len(out) - len(plain))] = b
    return out


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        self.byte = plain_bytes_of()

    def tokens(self, text):
        """(id, bytes) of both sides, or nothing where one does not spell the text."""
        if not text:
            return [], []
        one = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(f" {text}", add_special_tokens=False).ids]
        two = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            two.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = f" {text}".encode()
        return (one, two) if all(b"".join(t for _, t in side) == whole for side in (one, two)) else ([], [])

    def groups(self, text):
        one, two = self.tokens(text)
        ends = []
        for side in (one, two):
            at, places = 0, {}
            for i, data in side:
                at += len(data)
                places[at] = i
            ends.append(places)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        out, before = [], 0
        for cut in cuts:
            part = []
            for side in (one, two):
                at, ids = 0, []
                for i, data in side:
                    at += len(data)
                    if before < at <= cut:
                        ids.append(i)
                part.append(ids)
            out.append(tuple(part))
            before = cut
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        return len(one), len(two), out, links


def plain_rows(rows):
    plain = Plain()
    done = [(r["doc_id"], plain.groups(r["text"])) for r in rows]
    count = Counter(link for _, (_, _, _, links) in done for link in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, (n_a, n_b, groups, links) in done:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(11)
    letters = ["a", "b", "the", "tion", " ", "  ", "\n", "\t", "é", "漢", "🙂", "▁", "<|endoftext|>", "<s>", " ", "42", "!?", "'s", "Ġ", "ß", "́", "\r\n"]
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return out + [" leading", "trailing ", "<|endoftext|>", "x<|endoftext|>y", "the the the", "The quick brown fox", "ünïcödé wörds", "漢字かな交じり文", "a" * 500, "no▁space"]


@pytest.mark.parametrize("block_bytes", [1, 200, 16 << 20])
def test_alignment_equals_counting_bytes(spark, block_bytes):
    df = odd_documents(spark, texts()).where("n_chars is null or n_chars <> 5 or source <> 's2'").repartition(3)
    found = alignment.align_texts(df, "doc_id", "text", _bytes_50k, _pieces_32k, keep_groups=True, block_bytes=block_bytes)
    rows = alignment.link_totals(found).select("doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    expected = plain_rows(df.select("doc_id", "text").collect())
    assert sorted(map(tuple, rows), key=repr) == expected
    assert sum(e[1] > 0 for e in expected) > 40 and sum(e[1] == 0 for e in expected) > 4


def test_ranks_give_the_ids_of_the_library():
    """All Latin characters beside each kind of neighbour, and long runs."""
    fast, library = _bytes_50k(), alignment.byte_level(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [left + chr(c) + right for c in range(0x250) for left in ("", "a", "1", " ", "!", "\n", "'") for right in ("a", "1", " ", "  b", "!", "s", "\n")]
    rng = random.Random(2)
    texts += ["".join(chr(rng.randrange(0x250)) for _ in range(200)) for _ in range(300)] + [" " * 20_000 + "x", "a" * 20_000, "\n" * 5000, "<|endoftext|>" * 9]
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(fast.encode(texts), library.encode(texts)))


def test_long_texts_and_no_rows(spark):
    df = spark.createDataFrame([(1, "long words " * 20_000), (2, "漢" * 3000)], "doc_id long, text string")
    rows = {r["doc"]: r for r in alignment.link_totals(alignment.align_texts(df, "doc_id", "text", _bytes_50k, _pieces_32k)).collect()}
    assert rows[1]["n_groups"] == 40_001 and rows[2]["n_groups"] >= 3000 and rows[1]["n_best"] == 40_001
    none = alignment.align_texts(without_rows(df), "doc_id", "text", _bytes_50k, _pieces_32k)
    assert alignment.link_totals(none).count() == 0 and none.pairs.count() == 0


def test_windows_are_met_at_spaces_on_both_sides():
    a, b = _bytes_50k(), _pieces_32k()
    text = "some words, some words"
    keys, counts = alignment._windows(a, b, a.encode([text]), b.encode([text]))
    assert counts.tolist() == [len(keys)] == [4] and keys[1] != keys[0] and keys[0] == keys[2]
