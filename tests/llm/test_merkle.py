"""Manifests against trees built plainly."""

import hashlib
import zlib

from llm_fixtures import odd_documents, without_rows
from pyspark.sql import functions as F

from lexmill.llm import merkle
from lexmill.llm.common import lower_ascii


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return levels


def plain_path(levels, index):
    path = []
    for level in levels[:-1]:
        first = index - index % 16
        path.append((level[first:index], level[index + 1:first + 16]))
        index //= 16
    return path


def plain_audit(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, leaf, leaf now)."""
    key = lambda v: (v is not None, v)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (key(r[0]), r[2])) for s in sources}
    built = {s: levels_of([r[2] for r in t]) for s, t in trees.items()}
    top = levels_of([built[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (doc_id, _, leaf, now) in enumerate(trees[s]):
            path = plain_path(built[s], i) + plain_path(top, k)
            folded = now
            for left, right in path:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join("".join(a + b) for a, b in path))
            out.append((doc_id, leaf, built[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest_of(df):
    lead = [F.col(c) for c in FIELDS[:4]]
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_hash(*lead, lower_ascii(F.col("text"))))
    return merkle.build_manifest(df, "doc_id", "source", merkle.leaf_hash(*lead, F.col("text")), changed=changed)


def test_audit_equals_plain_trees_on_odd_rows(spark):
    df = odd_documents(spark, ["Some Text", "other", "Some Text", "ÀB C"] * 20)
    rows = []
    for r in df.select(*FIELDS).collect():
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        now = r["text"].translate(FOLD) if hit and r["text"] is not None else r["text"]
        rows.append((r["doc_id"], r["source"], plain_leaf(*r), plain_leaf(*r[:4], now)))
    assert any(r[2] != r[3] for r in rows)
    got = merkle.audit(manifest_of(df), "changed").collect()
    assert sorted(map(tuple, got), key=repr) == plain_audit(rows)
    assert merkle.audit(manifest_of(without_rows(df)), "changed").count() == 0


def test_trees_of_several_rounds_and_many_sources(spark):
    """One source of more than one block, full and ragged blocks, and more sources than a run holds."""
    sizes = {"hot": 9000, "full": 4096, "one more": 4097, None: 17, **{f"s{i}": 1 + i % 3 for i in range(300)}}
    rows = [(i * 7, s, f"{s} {i}") for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    manifest = merkle.build_manifest(df, "doc_id", "source", merkle.leaf_hash(F.col("doc_id"), F.col("text")), changed=F.lit(None).cast("binary"))
    assert len(manifest.logs) == 2
    plain = [(d, s, plain_leaf(d, t), plain_leaf(d, t)) for d, s, t in rows]
    assert sorted(map(tuple, merkle.audit(manifest, "changed").collect()), key=repr) == plain_audit(plain)
    proofs = merkle.read_proofs(manifest, spark.createDataFrame([(0, 3), (5, 1)], "tree long, at long")).collect()
    assert len(proofs) == 2
    for r in proofs:
        assert merkle.fold(bytes(r["leaf"]), [(s["left"], s["right"]) for s in r["siblings"]]) == bytes(r["root"])


def test_log_is_gapless_and_in_order_of_completion(spark):
    rows = [(i, "a", str(i)) for i in range(4500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    manifest = merkle.build_manifest(df, "doc_id", "source", merkle.leaf_hash(F.col("text")))
    got = sorted((r["position"], r["level"], r["index"], bytes(r["digest"]).hex()) for log in manifest.logs for r in log.collect())
    expected, open_runs = [], [[] for _ in range(6)]

    def append(level, index, digest):
        expected.append((len(expected), level, index, digest))
        open_runs[level].append(digest)

    digests = [plain_leaf(t) for _, _, t in rows]
    done = [0] * 6
    for digest in digests:
        append(0, done[0], digest)
        done[0] += 1
        last = done[0] == len(digests)
        for level in range(4):
            if len(open_runs[level]) == 16 or last:
                node = sha("".join(open_runs[level]))
                open_runs[level].clear()
                append(level + 1, done[level + 1], node)
                done[level + 1] += 1
            else:
                break
    assert got == expected


def test_positions_follow_from_sizes():
    assert [merkle.position(i, 0) for i in (0, 15, 16, 255, 256)] == [0, 15, 17, 270, 273]
    assert merkle.node_position(1, 0, 40) == 16 and merkle.node_position(1, 2, 40) == 42 and merkle.node_position(2, 0, 40) == 43
    assert [merkle.height(n) for n in (0, 1, 2, 16, 17, 256, 257, 4097)] == [0, 0, 1, 1, 2, 2, 3, 4]
