import hashlib
import itertools
import json
import random
import re
import string
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_fixtures import odd_documents, without_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmill.llm import decontaminate, licenses, pieces, quality, tokenfiles

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


# --- decontamination


def plain_hits(text, items):
    doc, hit, found = words(text), set(), set()
    for item, value in items:
        w = words(value)
        n = min(10, len(w))
        if not n:
            continue
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(doc) - n + 1):
            if tuple(doc[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found |= {str(item)} if item is not None else set()
    return len(doc), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 7])
def test_contamination_equals_brute_force(spark, broadcast_rows):
    rng = random.Random(4)
    say = lambda n, letters="abc": " ".join(rng.choice(letters) for _ in range(n))
    items = [(i, say(rng.randint(8, 40))) for i in range(12)] + [(12, "Kappa, LAMBDA"), (13, "theta"), (14, None), (15, "!!"), (None, say(30, "de")), (3, "eta theta iota")]
    texts = [say(rng.randint(1, 120)) for _ in range(12)] + [f"{say(5, 'xyz')} {items[0][1].upper()}; {say(5, 'xyz')}", items[16][1], items[2][1][: 2 * 9]]
    df = odd_documents(spark, texts)
    benchmark = spark.createDataFrame(items + items[:1], "item_id long, text string").withColumn("content", F.lit("clash"))
    rows = df.select("doc_id", "text").collect()
    expected = sorted(((r["doc_id"], *plain_hits(r["text"], items)) for r in rows), key=repr)
    found = decontaminate.find_contamination(df, "doc_id", "text", benchmark, "item_id", "text", broadcast_rows=broadcast_rows)
    assert sorted((tuple(r) for r in found.drop("text_key").collect()), key=repr) == expected
    kept = decontaminate.drop_contaminated(df, "doc_id", "text", benchmark, "item_id", "text")
    assert kept.columns == df.columns and kept.count() == sum(not e[-1] for e in expected)
    assert decontaminate.find_contamination(df, "doc_id", "text", without_rows(benchmark), "item_id", "text").where("contaminated").count() == 0
    assert decontaminate.find_contamination(without_rows(df), "doc_id", "text", benchmark, "item_id", "text").count() == 0


def test_any_shared_span_has_a_common_fingerprint(spark):
    rng = random.Random(6)
    span = [str(rng.randrange(50)) for _ in range(10)]
    pairs = [([str(rng.randrange(50)) for _ in range(rng.randrange(30))] + span + [str(rng.randrange(50)) for _ in range(rng.randrange(30))]) for _ in range(60)]
    frame = spark.createDataFrame([(p,) for p in pairs], "w array<string>")
    kept = [{x >> 32 for x in r[0]} for r in frame.select(decontaminate.winnow(F.col("w"))).collect()]
    assert set.intersection(*kept)
    assert sum(map(len, kept)) < 0.45 * sum(map(len, pairs))


# --- licences


def test_base_places_equal_brute_force(spark):
    rng = random.Random(7)
    vocabulary = "gnu general public license apache cc by mit the x".split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 200))) for _ in range(40)] + ["GNU General\nPublic--License", "MIT License" * 2]
    df = odd_documents(spark, texts)
    phrases = {p: label for label, texts in licenses.PHRASES.items() for p in texts}
    expected = []
    for r in df.select("doc_id", "text").collect():
        w = words(r["text"])
        at = [(i, label) for p, label in phrases.items() for k in [p.split()] for i in range(len(w) - len(k) + 1) if w[i:i + len(k)] == k]
        starts = [i for i, _ in at]
        expected.append((r["doc_id"], len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    found = licenses.scan_licenses(df, "doc_id", "text")
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in found.collect())
    assert licenses.scan_licenses(without_rows(df), "doc_id", "text").count() == 0


def test_matching_statistics_equal_brute_force():
    rng = random.Random(8)
    sequences = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 25))] for _ in range(6)]
    a = licenses.SuffixAutomaton(sequences)
    inside = {tuple(s[i:j]) for s in sequences for i, j in itertools.combinations(range(len(s) + 1), 2)}
    text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
    state = length = 0
    for i, word in enumerate(text):
        c = a.vocabulary.get(word)
        while state and c not in a.next[state]:
            state = a.link[state]
            length = a.length[state]
        state, length = (a.next[state][c], length + 1) if c in a.next[state] else (0, 0)
        longest = max((n for n in range(i + 2) if tuple(text[i + 1 - n:i + 1]) in inside), default=0)
        assert length == longest
        for number, end in a.ends[state].items():
            assert sequences[number][end + 1 - length:end + 1] == text[i + 1 - length:i + 1]


def test_a_notice_with_gaps_is_one_span():
    scanner = licenses.LicenseScanner(licenses.PHRASES, licenses.TEMPLATES)
    notice = licenses.TEMPLATES["bsd"][0].split()
    text = "some words before " + " ".join(notice[:9] + ["#", "inserted"] + notice[9:]) + " and after"
    *_, spans, score = scanner.scan(text.encode())
    assert [s[0] for s in spans] == ["bsd"] and spans[0][1] == 3 and spans[0][3] > 0.9 and 0.9 < score < 1.01
    assert scanner.scan(" ".join(notice[:6]).encode())[5] == []


def test_whole_templates_are_found_inside_longer_matches():
    letters = "a b c d e f g h i j k l m n o p q r s t".split()
    templates = {"long": [" ".join(letters)], "short": [" ".join(letters[:8])], "inner": [" ".join(letters[3:9])]}
    scanner = licenses.LicenseScanner({}, templates)
    *_, spans, score = scanner.scan((" ".join(letters[:10]) + " x").encode())
    assert spans == [("short", 0, 7, 1.0), ("inner", 3, 8, 1.0)] and score == 1.0
    rng = random.Random(12)
    for _ in range(200):
        text = [w for _ in range(rng.randint(1, 6)) for w in [*letters[rng.randrange(6):rng.randint(6, 20)], *["x"] * rng.randrange(3)]]
        spans = scanner.scan(" ".join(text).encode())[5]
        for label, (template,) in templates.items():
            size = len(template.split())
            for i in range(len(text) - size + 1):
                assert (text[i:i + size] != template.split()) or (label, i, i + size - 1, 1.0) in spans


# --- pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def every_way(lattice, text):
    symbols = pieces.SPACE + "".join(pieces.SPACE if c == " " else "\0" if c == pieces.SPACE else c for c in text)
    ways = []

    def go(i, score, ids):
        if i == len(symbols):
            ways.append((score, tuple(ids)))
            return
        for j in range(i + 1, min(len(symbols), i + 16) + 1):
            if symbols[i:j] in lattice.pieces:
                piece, s, _ = lattice.pieces[symbols[i:j]]
                go(j, score + s, [*ids, piece])
        if symbols[i] not in lattice.pieces:
            spelled, s = lattice._spell(pieces.SPACE if symbols[i] == "\0" else symbols[i])
            go(i + 1, score + s, [*ids, *spelled])

    go(0, 0.0, [])
    return sorted(ways, key=lambda w: -w[0])


def test_n_best_equals_all_segmentations():
    lattice = pieces.Lattice(MODEL, 5)
    rng = random.Random(9)
    for _ in range(150):
        text = "".join(rng.choice("the ion  é▁\nxñ.漢🙂 er") for _ in range(rng.randint(1, 9)))
        ways = every_way(lattice, text)
        _, score, ranked = lattice.encode(text)
        assert [round(s, 6) for s, _ in ranked] == [round(s, 6) for s, _ in ways[:5]] and score == ranked[0][0]
        found = [tuple(np.frombuffer(ids, lattice.dtype).tolist()) for _, ids in ranked]
        assert len(set(found)) == len(found) and set(found) <= {w for _, w in ways}
        assert all(lattice.decode(ids) == text.encode() for ids in found)


def test_encoding_of_odd_documents(spark):
    df = odd_documents(spark, ["  two  spaces  ", "x" * 3000, "▁", " "])
    rows = pieces.encode_texts(df, "text", MODEL).collect()
    assert len(rows) == df.count() and all(r["round_trip"] for r in rows)
    assert all(r["n_tokens"] == len(r["ids"]) == r["nbest"][0]["n_tokens"] and [n["score"] for n in r["nbest"]] == sorted((n["score"] for n in r["nbest"]), reverse=True) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert pieces.encode_texts(df, "text", MODEL).columns == [c for c in df.columns if c not in ("ids", "score")] + ["ids", "n_tokens", "score", "nbest", "round_trip"]
    assert pieces.encode_texts(without_rows(df), "text", MODEL).count() == 0
    decoded = pieces.decode_ids(pieces.encode_texts(df, "text", MODEL).select("text", "ids"), "ids", MODEL)
    assert all(r["decoded"] == (r["text"] or "") for r in decoded.collect())
    assert pieces.decode_ids(spark.createDataFrame([(None,), ([],)], "ids array<int>"), "ids", MODEL).collect() == [(None, None), ([], "")]


# --- token files

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_words_encode_as_the_whole_text():
    encoder, library = tokenfiles.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    rng = random.Random(10)
    letters = [*"aAbzÉéß'´.,!?19 \n\t\u00a0²½µΣςİıÅ\u0301漢字🙂\u2028ﬁǅ", "'s", "'t", "'re", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|"]
    assert encoder.encode(b"hello <|endoftext|> x") == encoder._packed(library.encode("hello <|endoftext|> x", add_special_tokens=False).ids)
    for _ in range(900):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        got = np.frombuffer(encoder.encode(text.encode()), encoder.dtype).tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_encode_in_chunks(monkeypatch, tmp_path):
    monkeypatch.setattr(tokenfiles, "CHUNK_BYTES", 50)
    monkeypatch.setattr(tokenfiles, "CACHE_PIECES", 9)
    monkeypatch.setattr(tokenfiles, "CALL_PARTS", 3)
    monkeypatch.setattr(tokenfiles, "CALL_TEXTS", 2)
    plain = json.loads(Path(WORDS).read_text())
    plain["model"]["end_of_word_suffix"] = None  # then no id tells where a part ends
    (tmp_path / "plain.json").write_text(json.dumps(plain))
    rng = random.Random(11)
    letters = [*"aAbzÉéß'´.,!?19  \n\x00\x1f\u00a0½µΣ漢🙂", "The", "don't", "</w>", "<|endoftext|>", "schöne", " "]
    texts = ["", " ", "\t\n", *("".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)), "x1" * 100, "", *["the end"] * 40]
    for path in (WORDS, str(tmp_path / "plain.json")):
        encoder, library = tokenfiles.WordEncoder(path), Tokenizer.from_file(path)
        cut = list(tokenfiles.chunks(pa.array([None, *texts]).fill_null("")[1:]))
        assert [t for c in cut for t in c.to_pylist()] == texts and all(len(c) == 1 or sum(len(t.encode()) for t in c.to_pylist()) <= 50 for c in cut)
        got = [np.frombuffer(ids.as_py(), encoder.dtype).tolist() for c in cut for ids in encoder.encode_all(c)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(tokenfiles.chunks(pa.array([], pa.string()))) == []


def test_library_sees_a_part_once(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHE_PIECES", 25)
    encoder, made = tokenfiles.WordEncoder(WORDS), []
    make = encoder.parts.make
    encoder.parts.make = lambda pieces: made.extend(pieces) or make(pieces)
    for i in range(300):  # rare words turn the tables over; what stays in use stays known
        encoder.encode(f'Common, common "COMMON" x{chr(97 + i % 20)}{chr(97 + i // 20)}'.encode())
    assert len(made) == len(set(made)) == 303


def test_token_files_round_trip(spark, tmp_path):
    df, path = odd_documents(spark, [f"text number {i}" for i in range(40)] + ["a <|endoftext|> b", "x<|startoftext|>y"]), str(tmp_path / "files")
    tokenfiles.write_token_files(df, "doc_id", "text", path, WORDS, 2)
    library = Tokenizer.from_file(WORDS)
    ids = [(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in df.select("doc_id", "text").collect()]
    got = tokenfiles.with_starts(spark, path, tokenfiles.read_tokens(spark, path)).collect()
    crc = lambda t: zlib.crc32(np.array(t, "<u4").tobytes())
    assert sorted((repr(r["id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((repr(d), len(t), crc(t)) for d, t in ids)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order[0] is None and order[1:] == sorted(order[1:])
    index = tokenfiles.read_index(spark, path)
    some = {r["id"]: r["ids"] for r in tokenfiles.read_records(spark, path, index.where("id % 7 = 2")).collect()}
    assert some == {d: t for d, t in ids if d is not None and d % 7 == 2}
    nothing = str(tmp_path / "empty")
    tokenfiles.write_token_files(without_rows(df), "doc_id", "text", nothing, WORDS, 2)
    assert tokenfiles.with_starts(spark, nothing, tokenfiles.read_tokens(spark, nothing)).count() == 0


def test_damage_is_noticed():
    content = tokenfiles.frame(b"abc") + tokenfiles.frame(b"defg")
    assert [bytes(p) for _, p in tokenfiles.frames(content + b"\n")] == [b"abc", b"defg"]
    for i in range(len(content)):
        broken = bytearray(content)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            list(tokenfiles.frames(bytes(broken)))


# --- quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge_quality(docs, "doc_id", "text", F.col("source"), F.col("lang"), labels.where("doc_id % 2 = 0"), "quality")
    held = judged.join(labels.where("doc_id % 2 = 1"), judged["id"] == labels["doc_id"]).select("keep", "quality").collect()
    assert len(held) > 100 and np.mean([r["keep"] == (r["quality"] == 1) for r in held]) >= 0.97


def test_sparse_sites_shrink_to_the_whole(spark):
    rows = [(f"h{h}", f"p{p}", 0.9 if (h + i) % (h + 2) else 0.1) for h in range(6) for p in range(3) for i in range(20)]
    rows += [("bad", "p", 0.05)] * 200 + [("few", "p", 0.05)] * 2
    got = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    mean = np.mean([p for *_, p in rows])
    of = lambda host: np.mean([r["path_posterior"] for r in got if r["host"] == host])
    assert of("bad") < of("few") < mean
    assert all(0 < r["posterior"] < 1 for r in got) and len(got) == len(rows)
    assert all((r["posterior"] < r["p"]) == (r["path_posterior"] < mean) for r in got if r["host"] == "bad")


def test_quality_of_odd_documents(spark):
    df = odd_documents(spark, ["Good words stand in this line.", "SPAM!! SPAM!! SPAM!!"])
    labels = spark.createDataFrame([(1, 1), (100, 1), (101, 0), (5, 0), (None, 1), (6, None), (1, 1)], "doc_id long, quality int")
    judged = quality.judge_quality(df, "doc_id", "text", F.col("source"), F.col("lang"), labels, "quality")
    rows = judged.collect()
    assert len(rows) == df.count() and all(not r["keep"] for r in rows if not r["n_words"])
    kept = quality.keep_good(df, "doc_id", "text", F.col("source"), F.col("lang"), labels, "quality")
    assert kept.columns == df.columns and kept.count() == sum(r["keep"] for r in rows)
    unlabelled = quality.judge_quality(df, "doc_id", "text", F.col("source"), F.col("lang"), without_rows(labels), "quality")
    assert {r["keep"] for r in unlabelled.collect() if r["n_words"]} == {True}
    assert quality.judge_quality(without_rows(df), "doc_id", "text", F.col("source"), F.col("lang"), labels, "quality").count() == 0
