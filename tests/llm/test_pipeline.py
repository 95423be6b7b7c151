"""The registered corpus queries against their SQL twins, and the pipeline stage by stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, connect
from palmares.llm import decontam, packing, queries, simhash
from palmares.llm.common import written
from palmares.queries.base import Query
from test_corpus_operators import least_reachable, replacements, slow_best_fit, slow_fingerprint, slow_leaks

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_twin(spark, name):
    assert compare(spark, connect(SF), SF, name, Query(queries.queries()[name], queries.oracle_sql()[name])) is None


def test_every_operator_has_one_query():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pages", "pipeline"]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, kept = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, SF), name)
        assert docs.columns == first.columns, name
        assert docs.join(before, "doc_id", "left_anti").count() == 0
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[0] >= 0.95 * first.count()
    first_stage = corpus_pipeline.STAGES[0][1](spark, first, SF)
    groups = simhash.near_duplicates(first_stage, shingle=4, radius=4).select("component_id").distinct().count()
    assert kept[1] == groups < kept[0]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontam.contaminated(docs, bench).count() == 0
    assert docs.where(F.col("text").rlike(r"\d@mail\d\.example\.com")).join(first, ["doc_id", "text"]).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_near_dedup_loses_no_text_where_ids_repeat(spark):
    """Rows are told by id and text: each group of copies leaves one row, whatever ids its rows have."""
    rng = random.Random(1)

    def sentence():
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(40))

    a, b, c = sentence(), sentence(), sentence()
    pool = [sentence() for _ in range(6)] + [None, ""]
    cases = [[(1, a), (1, b), (2, c)], [(0, a), (1, a), (1, b)], [(1, a), (1, a), (1, b)], [(None, a), (3, a), (None, b), (None, b)]]
    cases += [[(rng.choice([None, 0, 1, 2, 3]), rng.choice(pool)) for _ in range(25)] for _ in range(4)]
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    for rows in cases:
        docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS).withColumn("Key", F.lit(1)).withColumn("row", F.lit("x"))
        out = stage(spark, docs, SF)
        groups = {}
        for i, t in rows:
            groups.setdefault(t or "", []).append(i)
        want = [(min((i for i in ids if i is not None), default=None), t) for t, ids in groups.items()]
        assert out.columns == docs.columns and sorted(((r.doc_id, r.text or "") for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_equals_brute_force(spark):
    """Every stage on what its predecessor kept, against the plain form of its operator; copies of one id and benchmark passages are planted."""
    rng = random.Random(21)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    some = [r for r in docs.orderBy("doc_id").limit(12).collect()]
    planted = [(some[k].doc_id, some[k].text + " tail", "en", "s", 1) for k in range(3)] + [(9000 + k, some[k].text, "en", "s", 1) for k in range(3, 6)]
    planted += [(9100 + k, some[k].text[:300] + " " + bench[sorted(bench)[k]] + " " + some[k].text[:200], "en", "s", 1) for k in range(6, 9)]
    rng.shuffle(planted)
    docs = docs.union(spark.createDataFrame(planted, COLUMNS))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        kept.append([(r.doc_id, r.text) for r in docs.collect()])
    told, single, clean, private = kept
    # near-dedup: the least id, then the least text hash, of every group of fingerprints within 4 bits
    prints = [slow_fingerprint(t) for _, t in told]
    pairs = [(a, b) for a in range(len(told)) for b in range(a + 1, len(told)) if (prints[a] ^ prints[b]).bit_count() <= 4]
    groups = {}
    for k, root in least_reachable(range(len(told)), pairs).items():
        groups.setdefault(root, []).append(told[k])
    ids = sorted(min(i for i, _ in g) for g in groups.values())
    assert sorted(i for i, _ in single) == ids and len(single) < len(told) and set(single) <= set(told)
    # decontamination: what holds an item goes, everything else stays
    leaks = {k for k, _ in slow_leaks(dict(enumerate(t for _, t in single)), bench)}
    assert sorted(clean) == sorted(x for k, x in enumerate(single) if k not in leaks) and len(leaks) >= 3
    # PII: entities alone change
    assert len(private) == len(clean) and replacements({i: t for i, t in clean}, dict(private)) > 10
    # packing: the slow form over the whole table, which is one shard
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    lengths = sorted((n for _, t in private for n in pieces(len(t.split()) + 1)), reverse=True)
    bins = {}
    for r in rows:
        bins.setdefault((r.capacity, r.bin), []).append(r.n_tokens)
    assert sorted((c, tuple(sorted(v, reverse=True))) for (c, _), v in bins.items()) == slow_best_fit(lengths, packing.CAPACITIES)


def pieces(n, largest=max(packing.CAPACITIES)):
    return [largest] * (n // largest) + ([n % largest] if n % largest else [])


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_bear_odd_rows(spark, stage):
    rows = [(1, None, None, None, None), (None, "The of and " * 20, "en", "s", 220), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "The heart of and to " * 9, "en", None, 1), (3, "Other words of and to " * 9, "en", "s", 1)]
    odd = spark.read.parquet(f"{SF}/documents.parquet").union(spark.createDataFrame(rows, COLUMNS)).withColumn("Key", F.lit(1)).withColumn("row", F.lit("x"))
    function = corpus_pipeline.STAGES[stage][1]
    out = function(spark, odd, SF)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == odd.columns and 0 < out.count() <= odd.count()
    else:
        assert out.count() >= odd.count()
    assert function(spark, odd.limit(0), SF).count() == 0
