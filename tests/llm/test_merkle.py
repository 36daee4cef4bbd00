import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tabvitals.llm import merkle
from tabvitals.llm.queries import QUERIES, checksum


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def climb(tree, at):
    """Siblings left and right on each level."""
    for nodes in tree[:-1]:
        run = at - at % 3
        yield nodes[run:at], nodes[at + 1 : run + 3]
        at //= 3


def brute(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {
        s: sorted([r for r in rows if r[1] == s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        for s in sources
    }
    trees = {s: levels([leaf(r, r[4]) for r in ordered[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for number, s in enumerate(sources):
        for at, r in enumerate(ordered[s]):
            own = leaf(r, r[4])
            steps = [*climb(trees[s], at), *climb(top, number)]
            tampered = zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0
            folded = leaf(r, None if r[4] is None else r[4].replace("\n", "")) if tampered else own
            for left, right in steps:
                folded = H(*left, folded, *right)
            proof = H(*[d for left, right in steps for d in (*left, *right)])
            root = top[-1][0]
            out.append((str(r[0]), own, trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out)


def manifest(frame, depth, **options):
    text = F.translate("text", "\n", "")
    return merkle.manifest(frame, checksum("doc_id") % 2 == 0, text, depth=depth, **options)


def result(frame):
    columns = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((str(r.doc_id), *[r[c] for c in columns]) for r in frame.collect())


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, place int"


def table(n, seed=1):
    rnd = random.Random(seed)
    sources = ["hot"] * 6 + [None, "", "Ä", "z", "a", "\U0001f600", "\uffee", *map(str, range(20))]
    rows = [
        (i + 2**60, rnd.choice(sources), rnd.choice([None, "en"]), rnd.choice([None, i]), rnd.choice([None, "", "a\nb", "é"]))
        for i in range(n)
    ]
    rows += [(None, "hot", None, None, "x\ny"), (None, None, None, None, None), rows[0], rows[0]]
    return [*rows, (rows[1][0], "hot", "fr", 3, "other"), (-5, "hot", "en", 1, "long\n" * 50_000)]


@pytest.mark.parametrize(("n", "depth"), [(200, 1), (200, 2), (400, 3), (200, 9)])
def test_against_brute_force(spark, n, depth):
    rows = table(n)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = result(manifest(frame, depth))
    assert out == brute(rows)
    assert {r[-1] for r in out} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1, 1, 1], [3], [4], [9], [10], [27, 1], [28, 2, 9]])
def test_sizes(spark, sizes):
    rows = [(100 * s + i, f"s{s}", "en", 1, f"t\n{i}") for s, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    for depth in (1, 2):
        assert result(manifest(frame, depth)) == brute(rows)


def test_versions_share_what_they_do_not_copy():
    digests = [H(str(i)) for i in range(25)]
    block = merkle.Block(digests)
    copied = block.version(13, H("other"))
    assert len(copied) == 4 and copied[-1].digest == levels([*digests[:13], H("other"), *digests[14:]])[-1][0]
    old, new = block.top, copied[-1]
    for _ in range(3):
        different = [(a, b) for a, b in zip(old.children, new.children, strict=True) if a is not b]
        assert len(different) == 1
        old, new = different[0]
    assert block.top.digest == levels(digests)[-1][0]  # the first version is still there


def test_copied_nodes_are_a_way_to_the_root(spark):
    frame = spark.createDataFrame([(*r, "x", 1) for r in table(150)], SCHEMA)
    for r in manifest(frame, 2, versions=True).collect():
        if r.copied is not None:
            assert r.copied[-1] == r.folded_root
        else:
            assert r.verified


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert manifest(frame, 2).count() == 0


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs]
    assert result(QUERIES["op13_merkle"](spark, folder)) == brute(rows)
