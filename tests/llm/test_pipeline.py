import hashlib
import inspect
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from tabvitals.llm import bpe, quality
from tabvitals.llm.common import plain_words
from test_decontaminate import distance, edited
from test_lines import expected as without_lines
from test_near_dups import brute
from tabvitals.llm.decontaminate import most_edits

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, quality string"
GIVEN = "/root/testdata/sf0.01"


def fixture():
    """Given documents, and cases of every stage: items, copies, near copies, odd rows."""
    rnd = random.Random(9)
    docs = pq.read_table(f"{GIVEN}/documents.parquet").to_pylist()
    docs = [d for d in docs if d["n_chars"] < 4000][:120]
    items = pq.read_table(f"{GIVEN}/benchmark.parquet").to_pylist()[:25]
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"], "q") for d in docs]
    good = [d["text"] for d in docs if d["n_chars"] > 600]
    for i, item in enumerate(items[:12]):
        passage = edited(rnd, item["text"].split(" "), i % 3, ["thing"])
        text = f"{good[i]}\n{' '.join(passage)}\n{good[i + 1]}"
        rows.append((5000 + i, text, "en", "src1", len(text), "q"))
    for i in range(10):
        text = good[20 + i]
        words = text.split(" ")
        words[rnd.randrange(len(words))] = "changed"
        rows += [(6000 + i, text, "en", None, len(text), "q"), (6100 + i, " ".join(words), "en", "src2", 1, "q")]
    rows += [(7000, None, None, None, None, None), (7001, "", "en", "src1", 0, "q"), (None, good[40] + " more", None, "s", 1, "q")]
    rows += [(7003, good[45] + " again", "en", "src3", 5, "q")] * 2
    return rows, items


def plain(rows, items):
    """The pipeline row by row: what is left, and its tokens."""
    measures = [quality.measured(r[1]) for r in rows]
    votes = np.array([m[6:] for m in measures], float)
    *_, post = quality.estimated(votes, np.ones(len(rows)))
    rows = [r for r, m, p in zip(rows, measures, post, strict=True) if not m[5] and p >= 0.5]
    cut = without_lines([(i, r[3], r[1]) for i, r in enumerate(rows)], 0.1, 3)
    rows = [(r[0], c[2]) for r, c in zip(rows, cut, strict=True)]
    sets, group = brute(rows, 5)
    chosen = {}
    for i, (row, s) in enumerate(zip(rows, sets, strict=True)):
        if s:
            best = chosen.setdefault(group[i], i)
            if (row[0] is None, row[0] or 0) < (rows[best][0] is None, rows[best][0] or 0):
                chosen[group[i]] = i
    rows = [r for i, r in enumerate(rows) if not sets[i] or chosen[group[i]] == i]
    passages = [plain_words(x["text"]) for x in items]
    rows = [
        r
        for r in rows
        if all(distance(p, plain_words(r[1])) > most_edits(len(p)) for p in passages)
    ]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    out = []
    for key, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        out.append((str(key), ids, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def test_against_brute_force(spark, tmp_path):
    rows, items = fixture()
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(x["item_id"], x["text"]) for x in items], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    got = sorted((str(r.doc_id), list(r.ids), r.decoded_sha256) for r in out)
    assert got == plain(rows, items)
    left = {r.doc_id for r in out}
    assert not left & set(range(5000, 5012)) and len(left & set(range(6100, 6110))) == 0
    assert len(out) > 60


def test_stages(spark):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES:
        assert isinstance(name, str) and len(inspect.signature(stage).parameters) == 3
    docs = spark.createDataFrame(fixture()[0][:30], SCHEMA)
    for docs_in in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs_in, GIVEN)
            assert out.columns == docs.columns and out.count() <= docs_in.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), GIVEN).count() == 0


def test_texts_go_to_python_in_small_batches(spark):
    """For each stage that runs Python, and only if the session has no limit of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    texts = spark.range(0, 4000, 1, 1).selectExpr("repeat(cast(id as string), 1000) as text")
    docs = spark.createDataFrame(fixture()[0][:3], SCHEMA)
    try:
        for stage in [s for k, s in corpus_pipeline.STAGES if k != "line dedup"]:
            spark.conf.unset(name)
            stage(spark, docs, GIVEN)
            found = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
            assert sum(found) > 14e6 and max(found) < 5e6
        spark.conf.set(name, "1m")
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def test_encoders_are_small():
    """What an encoder keeps of many words, its vocabulary aside; and ids stay the same."""
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    coder = bpe.Coder(vocabulary, corpus_pipeline.KEPT_WORDS)
    texts = [" ".join(f"w{i:x}" for i in range(a, a + 20_000)) for a in range(0, 400_000, 20_000)]
    tracemalloc.start()
    first = [hashlib.sha256(ids.encode()).digest() for t in texts for ids in coder.listed([t])]
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 50e6
    assert [hashlib.sha256(ids.encode()).digest() for ids in coder.listed(texts)] == first
