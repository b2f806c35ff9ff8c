"""The pipeline against its stages by brute force, and the registered queries."""

import collections

import corpus_pipeline
import pytest
from llm_helpers import SMALL, table, texts_of
from pyspark.sql import functions as F
from test_duplicates import groups, near_pairs, removed, shingle_set
from test_texts import encoded, sha, tokenizer  # noqa: F401

import fractions
import math

import numpy as np

import __spark_entry__ as entry
from winnow.llm import entries, mixing, quality


def test_pipeline(spark, tokenizer):  # noqa: F811
    docs, labels = table(spark, "documents"), table(spark, "labels")
    texts = texts_of(quality.keep_good(docs, quality.fit(docs, labels)))
    assert 0 < len(texts) < docs.count()
    sets = {i: shingle_set(t) for i, t in texts.items()}
    top = groups(near_pairs(sets), sets)
    kept = sorted((i, t.encode()) for i, t in texts.items() if top[i] == i)
    want = {i: np.frombuffer(b, np.uint8)[~mask].tobytes().decode(errors="ignore") for i, b, mask in removed(kept)}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(list(want))
    for r in got:
        ids = np.array(encoded(tokenizer, want[r.doc_id]), "<u4").tobytes()
        assert (r.ids, r.ids_sha256, r.decoded_sha256) == (bytearray(ids), sha(ids), sha(want[r.doc_id].encode()))


#: Names that the stages use themselves.
CLASHING = ("_own", "_ranges", "_doc_id", "_source", "_position", "ranges", "position", "nth", "row", "d", "s", "file_no", "row_no", "k", "t", "r", "near", "component_id")


def test_stages_keep_the_columns(spark, odd):
    docs = odd.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING)))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.dtypes == docs.dtypes and {r._position for r in out.select("_position").collect()} == {4}
        assert stage(spark, docs.limit(0), SMALL).isEmpty()
    assert corpus_pipeline.bpe_stage(spark, docs, SMALL).count() == docs.count()
    assert corpus_pipeline.bpe_stage(spark, docs.limit(0), SMALL).isEmpty()


def test_the_mixing_stage_takes_effect(spark, tmp_path):
    """The last stage finds the order of the mix in the table before it, and another one where that stage is left out."""
    docs = table(spark, "documents").repartition(3)
    docs.write.parquet(str(tmp_path / "plain"))
    corpus_pipeline.mixing_stage(spark, docs, SMALL).write.parquet(str(tmp_path / "mixed"))
    places = {name: {(r.doc_id, r.slot, r.position) for r in corpus_pipeline.bpe_stage(spark, spark.read.parquet(str(tmp_path / name)), SMALL).collect()} for name in ("plain", "mixed")}
    assert places["mixed"] == {(r.doc_id, r.slot, r.position) for r in mixing.mix(docs).collect()} != places["plain"]
    assert len(places["plain"]) == docs.count()


def test_all_are_registered(spark):
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(entries.queries()) <= set(names)


def mix_brute(sources, weights=None):
    """(source, block) by slot: in each slot the released block that is due first; a new phase when a source runs out."""
    left = {s: -(-n // mixing.BLOCK_ROWS) for s, n in sources.items()}
    weights = weights or {s: n**mixing.TEMPER for s, n in sources.items()}
    out, done = [], dict.fromkeys(left, 0)
    while live := [s for s in left if done[s] < left[s]]:
        total = sum(fractions.Fraction(weights[s]) for s in live)
        w, first, t = {s: fractions.Fraction(weights[s]) / total for s in live}, dict(done), 0
        while all(done[s] < left[s] for s in live):
            ready = [(math.ceil((done[s] - first[s] + 1) / w[s]), s) for s in live if math.floor((done[s] - first[s]) / w[s]) <= t]
            s = min(ready)[1]
            out.append((s, done[s]))
            done[s], t = done[s] + 1, t + 1
    return out


@pytest.fixture(scope="module")
def mixed(spark, tmp_path_factory):
    """Documents of uneven sources, one long text and rows that repeat a doc_id, and the last stages' rows for them as read again."""
    rows = [(i, f"text number {i}", "en", "abcd"[(i % 3 > 0) + (i % 7 > 4) + (i % 11 > 9)], 1) for i in range(700)]
    rows += [(3, "long text " * 9000, "en", "a", 1), (3, "again", "en", "a", 1), (None, "none", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    path = str(tmp_path_factory.mktemp("mixed") / "out")
    corpus_pipeline.mixing_stage(spark, docs, SMALL).write.parquet(path)
    return rows, corpus_pipeline.bpe_stage(spark, spark.read.parquet(path), SMALL).collect()


def test_the_mix_reaches_the_result(spark, mixed, tokenizer):  # noqa: F811
    rows, got = mixed
    sources = collections.defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        sources["\0" if source is None else source].append((doc_id, text))
    hashes = {r.doc_id: r.h % 2**64 for r in spark.createDataFrame([(r[0],) for r in rows], "doc_id long").select("doc_id", F.xxhash64(F.lit(0), "doc_id").alias("h")).collect()}
    for some in sources.values():
        some.sort(key=lambda r: (hashes[r[0]], r[0] or 0, r[1]))
    slots = mix_brute({s: len(some) for s, some in sources.items()})
    want = [(slot, slot * mixing.BLOCK_ROWS + i, doc_id, sha(text.encode())) for slot, (s, b) in enumerate(slots) for i, (doc_id, text) in enumerate(sources[s][b * mixing.BLOCK_ROWS :][: mixing.BLOCK_ROWS])]
    assert [(r.slot, r.position, r.doc_id, r.decoded_sha256) for r in got] == want


def test_run_is_in_the_order_of_the_mix(spark):
    got = [r.position for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert got == sorted(set(got))
