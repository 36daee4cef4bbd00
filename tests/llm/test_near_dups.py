import random
import tracemalloc

import pytest

from tabvitals.llm import near_dups
from tabvitals.llm.common import WordHashes
from tabvitals.llm.components import components

SCHEMA = "doc_id int, text string, kept string, row_hash int"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def shingle_set(text, width):
    mine = words(text)
    if len(mine) < width:
        return {tuple(mine)} if mine else set()
    return {tuple(mine[i : i + width]) for i in range(len(mine) - width + 1)}


def brute(rows, width):
    """Component of each row by comparing all pairs: the rows that can be reached."""
    sets = [shingle_set(t, width) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    return sets, group


def corpus(seed):
    """Copies, near copies, chains, short texts, and a family whose members are borderline."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]

    def text(n):
        return rnd.choices(vocabulary, k=n)

    def edit(mine, k):
        mine = list(mine)
        for at in rnd.sample(range(len(mine)), k):
            mine[at] = rnd.choice(vocabulary)
        return mine

    out = [text(rnd.choice([1, 2, 4, 30, 200])) for _ in range(60)]
    for _ in range(6):
        original = text(rnd.choice([20, 120]))
        out += [original] * 3 + [edit(original, rnd.choice([1, 2])) for _ in range(5)]
        for _ in range(4):
            original = edit(original, 1)
            out.append(original)
    original = text(100)
    out += [edit(original, rnd.choice([3, 4, 5, 6])) for _ in range(60)]
    rows = [" ".join(t) for t in out]
    rows += ["", None, " \n\t ", "One  two", "one two", "one", "ONE"]
    rnd.shuffle(rows)
    return [(i * 3 + 5, t, "x", 1) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, width, block", [(1, 2, 512), (2, 2, 8), (3, 5, 512)])
def test_against_brute_force(spark, monkeypatch, seed, width, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rows = corpus(seed)
    sets, group = brute(rows, width)
    first = {}
    for (key, *_), g in zip(rows, group, strict=True):
        first[g] = min(first.get(g, key), key)
    expected = sorted(
        (key, len(s), first[g], key == first[g])
        for (key, *_), s, g in zip(rows, sets, group, strict=True)
    )
    out = near_dups.grouped(spark.createDataFrame(rows, SCHEMA).repartition(3), width=width)
    got = sorted(tuple(r) for r in out.select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == expected
    assert len(first) < len(rows) - 20


ODD = [
    (None, "a b c d e f g h", "x", 1),
    (None, "a b c d e f g h", "x", 1),
    (None, "only rows without a key have this text", "x", 1),
    (None, "Only rows without a key have this TEXT", "x", 1),
    (9, "a b c d e f g h", "x", 1),
    (9, "a b c d e f g h", "x", 1),
    (4, "a b c d e f g  H", "x", 1),
    (4, "something else that is in no group", "x", 1),
    (7, None, "x", 1),
    (7, None, "x", 1),
    (8, " ", "x", 1),
    (2, "long " + " ".join(map(str, range(30_000))), "x", 1),
    (3, "long " + " ".join(map(str, range(30_000))) + " end", "x", 1),
]


def test_odd_rows(spark):
    frame = spark.createDataFrame(ODD, SCHEMA).repartition(2)
    got = near_dups.grouped(frame, width=2).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        map(
            str,
            [
                *[(None, 4, False)] * 2,
                *[(None, None, True)] * 2,
                *[(9, 4, False)] * 2,
                *[(4, 4, True)] * 2,
                *[(7, 7, True)] * 2,
                (8, 8, True),
                (2, 2, True),
                (3, 2, False),
            ],
        )
    )
    stage = near_dups.without_copies(frame, width=2)
    assert stage.columns == frame.columns
    kept = sorted((str(r.doc_id), r.text and r.text[:5].lower()) for r in stage.collect())
    assert kept == sorted(
        [("None", "only "), ("4", "a b c"), ("4", "somet"), ("7", None), ("7", None), ("8", " "), ("2", "long ")]
    )


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dups.grouped(empty).count() == 0
    assert near_dups.without_copies(empty).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(200, i) for i in range(100, 160)]
    ring = [(300 + i, 300 + (i + 1) % 7) for i in range(7)]
    links = spark.createDataFrame(chain[::-1] + star + ring + star, "a bigint, b bigint")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {
        **{i: 0 for i in range(61)},
        **{i: 100 for i in [200, *range(100, 160)]},
        **{i: 300 for i in range(300, 307)},
    }


def test_small_tables_are_few_files(spark):
    """Of links and labels, though a session has many partitions for its texts."""
    conf = {"spark.sql.shuffle.partitions": "160", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    links = spark.createDataFrame([(i, i + 1500) for i in range(1500)], "a bigint, b bigint")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        labels = components(links)
        assert 1 < len(labels.inputFiles()) <= max(20, 2 * spark.sparkContext.defaultParallelism)
        assert sorted(map(tuple, labels.collect())) == sorted(
            (n, i) for i in range(1500) for n in (i, i + 1500)
        )
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def family(n, outsiders, seed=5):
    """Near copies of a text, and texts that share buckets with them but are below the limit."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(20_000)]
    original = rnd.choices(vocabulary, k=120)

    def edited(k):
        mine = list(original)
        for at in rnd.sample(range(len(mine)), k):
            mine[at] = rnd.choice(vocabulary)
        return " ".join(mine)

    return [edited(3) for _ in range(n)] + [edited(20) for _ in range(outsiders)]


def tasks_of(spark, texts):
    """Rows dealt to tasks by comparing what stars leave over, and the number of components."""
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    sketches = near_dups.sketched(frame, "doc_id", "text", 2)
    nodes = near_dups.classes(sketches)
    found = near_dups.members(nodes)
    texts = near_dups.texts_of(frame, "doc_id", "text", nodes.select("node", "row_hash", "text_hash"))
    labels = components(near_dups.confirmed(near_dups.stars(found), texts, 2, 80))
    labelled = found.join(labels, "node", "left").withColumn(
        "component", near_dups.F.coalesce("component", "node")
    )
    return near_dups.dealt(labelled.drop("band"), near_dups.open_buckets(labelled))


def test_an_outsider_costs_a_family_one_comparison_each(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 64)
    texts = family(1500, 2)
    rows = tasks_of(spark, texts)
    per_bucket = rows.groupBy("bucket").count().collect()
    sizes = {r.bucket: r["count"] for r in per_bucket}
    assert sizes  # the outsiders do share buckets
    for r in rows.select("bucket", "n_shingles").distinct().collect():
        assert sizes[r.bucket] <= len(texts) * 1.2 + 100
    tasks = rows.groupBy("bucket", "low", "high").count().agg({"count": "max"}).first()[0]
    assert tasks < 64 * 4  # blocks are small, whatever the family


def test_buckets_with_the_same_members_are_compared_once(spark):
    labelled = spark.createDataFrame(
        [(n, b, b, c) for b in (7, 9, 11) for n, c in ((1, 1), (2, 2), (3, 2))] + [(1, 20, 0, 1), (3, 20, 0, 2)],
        "node bigint, bucket bigint, band int, component bigint",
    )
    out = {tuple(r) for r in near_dups.open_buckets(labelled).collect()}
    assert out == {(7, 7, 2, 3, 1), (20, 0, 2, 2, 1)}



def test_kept_hashes_are_few_enough_for_small_workers():
    """And hashes stay the same when all that are kept are dropped."""
    hashes = WordHashes()
    words = [b"word-%d" % i for i in range(250_000)]
    tracemalloc.start()
    first = hashes.of(words)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 15e6
    assert (hashes.of(words) == first).all()
