"""What work queries do where rows repeat: pairs are found for different values, not for all rows, and in many tasks."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomwright.functions import stem
from loomwright.operators import aliases, blocking, knowledge, relations, resolution, text
from loomwright.plans import catalogue, entity_queries  # noqa: F401
from loomwright.plans.catalogue import QUERIES

ROWS = [("red bolt", "A", 4), ("red bolt", "A", 5), ("red bolt", "B", 40), ("red ring", "A", 4), ("old rod", "B", 7)]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Each value on 6 rows of either side."""
    d = str(tmp_path_factory.mktemp("parts"))
    rows = [(2 * (i * 6 + r) + side, *v) for i, v in enumerate(ROWS) for r in range(6) for side in (0, 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").withColumn("p_type", F.lit("x")).write.parquet(f"{d}/part.parquet")
    return d, rows


def score(a, b):
    return round(0.42 * (a[1] == b[1]) + 0.18 * (a[2] == b[2]) + 0.4 * min(a[3], b[3]) / max(a[3], b[3]), 6)


def outcomes(rows):
    """(subject, staging): (score, truth)"""
    out = {}
    for a, b in itertools.product([r for r in rows if r[0] % 2 == 0], [r for r in rows if r[0] % 2]):
        truth = (a[1], a[3]) == (b[1], b[3])
        s = score(a, b) if a[1][:5] == b[1][:5] and score(a, b) >= 0.7 else 0.0
        if s or truth:
            out[a[0], b[0]] = (s, truth)
    return out


def test_values_are_scored_once(spark, parts):
    a, b = catalogue._values(spark, parts[0])
    assert a.count() == b.count() == len(ROWS) and {r["n"] for r in a.collect()} == {6}
    want = {k: v[0] for k, v in outcomes(parts[1]).items() if v[0]}
    assert catalogue._scored_values(a, b).count() * 36 == len(want)
    assert {(r["subject"], r["staging"]): r["score"] for r in catalogue._scored(spark, parts[0]).collect()} == want


@pytest.mark.parametrize("name", ["full_outcomes", "duplicate_relations", "dedup_candidates", "entity_resolution", "unmatched_to_master", "pairs_completeness", "score_buckets", "average_of_sweep"])
def test_queries_over_values(spark, parts, name):
    d, rows = parts
    found = outcomes(rows)
    scored = {k: v[0] for k, v in found.items() if v[0]}
    best = {t: min((-s, a) for (a, b), s in scored.items() if b == t) for t in {b for _, b in scored}}
    got = QUERIES[name](spark, d).collect()
    if name == "full_outcomes":
        assert sorted(tuple(r) for r in got) == sorted((*k, *v) for k, v in found.items())
    elif name == "duplicate_relations":
        both = [(str(a), str(b), s) for (a, b), s in scored.items()]
        assert sorted((r["src"], r["dst"], r["value"]) for r in got) == sorted(both + [(b, a, s) for a, b, s in both])
    elif name == "dedup_candidates":
        want = {x: sorted((b, s) for (a, b), s in scored.items() if a == x) for x in {a for a, _ in scored}}
        assert {r["subject"]: (r["n"], r["best"], r["candidates"]) for r in got} == {a: (len(x), max(s for _, s in x), ";".join(f"{b}:{round(s * 1e6)}" for b, s in x)) for a, x in want.items()}
    elif name == "entity_resolution":
        assert {r["staging"]: (-r["score"], r["subject"]) for r in got} == best and len(got) == len(best)
    elif name == "unmatched_to_master":
        assert {r["id"]: (r["master"], r["score"]) for r in got} == {r[0]: (f"m{best[r[0]][1]}", -best[r[0]][0]) if r[0] in best else (f"master-{r[0]}", 1.0) for r in rows if r[0] % 2}
    elif name == "pairs_completeness":
        gold = {(a[0], b[0]) for a in rows for b in rows if a[0] % 2 == 0 and b[0] % 2 and a[1:3] == b[1:3]}
        assert [tuple(r) for r in got] == [(len(gold & scored.keys()), len(gold), len(gold & scored.keys()) / len(gold))]
    elif name == "score_buckets":
        assert sum(r["n"] for r in got) == len(found) and sum(r["n"] for r in got if r["truth"]) == sum(t for _, t in found.values())
    else:
        f = []
        for h in range(1, 10):
            tp, fp, fn = (sum(x(s, t) for s, t in found.values()) for x in (lambda s, t: s >= h / 10 and t, lambda s, t: s >= h / 10 and not t, lambda s, t: s < h / 10 and t))
            f.append(2 * tp / (2 * tp + fp + fn) if tp else 0)
        assert got[0]["f1"] == pytest.approx(sum(f) / 9, abs=2e-6)


def test_one_large_block_takes_many_tasks(spark):
    df = spark.range(3000).select("id", F.lit("same").alias("name"))
    key = {"simple": blocking.simple(F.col("name"))}
    p = blocking.block_pairs(df.where("id % 2 = 0"), df.where("id % 2 = 1"), (key, key), 1 << 16)
    per_task = [r["count"] for r in p.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 1500 * 1500 and len(per_task) >= 4 and max(per_task) < 1500 * 1500 / 2


def test_ids_of_one_value_are_listed_in_parts(spark):
    df = spark.range(100).select("id", F.lit("v").alias("k"))
    one = spark.range(1).select(F.struct(F.lit("v").alias("k")).alias("subject"), F.struct(F.lit("v").alias("k")).alias("staging"), F.lit(2).alias("x"))
    got = resolution.expand(one, df.where("id < 40"), df.where("id >= 40"), ["k"], most=7).collect()
    assert sorted((r["subject"], r["staging"]) for r in got) == [(a, b) for a in range(40) for b in range(40, 100)]


def test_features_of_values(spark, parts):
    """Features are taken for pairs of different values; the classifier sees each row pair all the same."""
    f = entity_queries._features(spark, parts[0])
    first = lambda v: v[0][:5]
    assert f.count() == sum(first(a) == first(b) for a, b in itertools.product(ROWS, ROWS))
    got = QUERIES["pair_features"](spark, parts[0]).collect()
    sides = [[r for r in parts[1] if r[0] % 2 == x] for x in (0, 1)]
    assert sorted(tuple(r) for r in got) == sorted((a[0], b[0], float(a[1] == b[1]), round(min(a[3], b[3]) / max(a[3], b[3]), 6), a[1:3] == b[1:3]) for a, b in itertools.product(*sides) if a[1][:5] == b[1][:5])
    r = QUERIES["duplicate_classifier"](spark, parts[0]).first()
    assert 0 < r["tp"] + r["fn"] < sum(x["correct"] for x in got)


def test_class_paths_keep_no_inferred_constraints(spark, monkeypatch):
    kept, durable = [], aliases.durable
    monkeypatch.setattr(aliases, "durable", lambda df: kept.append(durable(df)) or kept[-1])
    before = spark.conf.get("spark.sql.constraintPropagation.enabled")
    n = spark.range(1, 60).select(F.col("id").alias("child"))
    edges = n.select("child", F.expr("child div 3").alias("parent")).union(n.select("child", F.expr("child div 4 + 1").alias("parent")).where("child <> parent"))
    paths = aliases.subclass_paths(edges, 0)
    assert {x._jdf.queryExecution().optimizedPlan().constraints().size() for x in kept} == {0}
    assert spark.conf.get("spark.sql.constraintPropagation.enabled") == before
    assert {r["node"]: list(r["path"]) for r in paths.where("node in (0, 2, 9)").collect()} == {0: [0], 2: [0, 2], 9: [0, 1, 3, 9]}


def test_part_sizes_are_those_of_split(spark):
    rows = [("t", k, side, i) for k, n, m in (("a", 23, 9), ("b", 1, 50), ("c", 5, 5), ("d", 3, 0)) for side, count in (("subject", n), ("staging", m)) for i in range(count)]
    m = spark.createDataFrame(rows, "tag string, key string, side string, id long")
    for most in (1, 7, 40):
        parts = blocking.split(m, most).groupBy("key", "part").agg(*[F.count_if(F.col("side") == x).alias(x) for x in ("subject", "staging")])
        want = {(r["key"], r["subject"], r["staging"]): r["count"] for r in parts.groupBy("key", "subject", "staging").count().collect()}
        assert {(r["key"], r["subject"], r["staging"]): r["parts"] for r in blocking.part_sizes(m, most).collect()} == want


def test_block_split_makes_no_row_of_a_part(spark, tmp_path):
    """2,000 x 1,000 members of one block are some 50,000 parts, of which only sizes are counted."""
    spark.range(2000).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1000).select(F.col("id").alias("s_suppkey"), F.lit(1).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    df = QUERIES["block_split"](spark, str(tmp_path))
    assert [tuple(r) for r in df.collect()] == [("1", 2_000_000, True, True)]
    assert "explode" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_gold_pairs_of_several_keys_come_once(spark):
    left = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3), (3, None, 4)], "id int, k string, n int")
    right = spark.createDataFrame([(7, "x", 1), (8, "y", 3), (9, None, None), (7, "y", 9), (10, "undefined", 4)], "id int, k string, n long")
    got = resolution.gold_standard(left, right, ["k", "n"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 7), (1, 8), (2, 7), (2, 8), (3, 10)]
    assert "Aggregate [subject" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_of_one_group_take_many_tasks(spark):
    df = spark.range(2000).select(F.col("id").alias("a"), F.lit(1).alias("g"))
    p = blocking.group_pairs(df, df.withColumnRenamed("a", "b"), ["g"], 1 << 16).where("a < b")
    per_task = [r["count"] for r in p.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 2000 * 1999 // 2 and len(per_task) >= 4 and max(per_task) < sum(per_task) / 2


def test_relations_within_are_imported_relations(spark):
    rows = [("a", 1, "x"), ("b", 2, "x"), ("a", 3, "x"), ("c", 4, "y"), ("d", 5, "y"), ("gone", 6, "y")]
    m = spark.createDataFrame(rows, "name string, at int, relation string")
    names = spark.createDataFrame([(10, "a"), (11, "a"), (20, "b"), (30, "c"), (40, "d")], "id int, name string")
    pairs = m.alias("l").join(m.alias("r"), F.expr("l.relation = r.relation and l.at < r.at")).selectExpr("l.name as subject", "r.name as object", "l.relation as relation")
    want = sorted(tuple(r) for r in knowledge.import_relations(pairs, names).collect())
    got = knowledge.relations_within(m, names)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 4


def test_block_statistics_count_pairs_of_values(spark, parts):
    d, rows = parts
    gold = [(a, b) for a, b in itertools.product(rows, rows) if a[0] % 2 == 0 and b[0] % 2 and (a[1], a[3]) == (b[1], b[3])]
    got = {r["tag"]: (r["found"], r["gold"]) for r in QUERIES["block_statistics"](spark, d).collect()}
    assert got == {"simple": (len(gold), len(gold)), "combined": (len(gold), len(gold)), "brand": (sum(a[2] == b[2] for a, b in gold), len(gold))}
    a, b = catalogue._values(spark, d)
    assert catalogue._gold_values(a, b, "name", "size").count() * 36 == len(gold)


def test_cosine_of_blocks(spark):
    """Blocks of any size give the same pairs, and candidates are hardly more than results where all documents share a rare term."""
    rng = random.Random(5)
    base = {i: [f"w{rng.randrange(400)}" for _ in range(20)] for i in range(40)}
    docs = {i: base[i % 40][: 20 - i % 5] + [f"own{i}", f"both{i % 40}"] for i in range(160)}
    rows = [(i, t, float(n * (1 + len(t)))) for i, x in docs.items() for t, n in Counter(x).items()]
    tfidf = spark.createDataFrame(rows, "doc_id long, term string, tfidf double")
    w = {i: {t: x for j, t, x in rows if j == i} for i in docs}
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in w.items()}
    cosine = {(a, b): sum(x * w[b].get(t, 0) for t, x in w[a].items()) / (norm[a] * norm[b]) for a, b in itertools.combinations(docs, 2)}
    want = {p: c for p, c in cosine.items() if c >= 0.8}
    for block in (1 << 12, 30):
        got = {(r["a"], r["b"]): r["cosine"] for r in text.cosine_search(tfidf, block=block).collect()}
        assert got.keys() == want.keys() and all(abs(got[p] - c) < 1e-9 for p, c in want.items())
    assert 50 < len(want) < len(cosine) / 4
    plan = text.cosine_search(tfidf)._jdf.queryExecution().optimizedPlan().toString()
    assert "term" not in plan  # no pairs of documents and terms


def test_stems_of_few_rows_at_a_time(spark):
    rows = [(i, None if i % 7 == 3 else [f"Häuser{'n' * (i % 3)}", None, "lief"][: i % 4]) for i in range(50)]
    df = spark.createDataFrame(rows, "i int, t array<string>").coalesce(1)
    want = {i: None if t is None else [None if x is None else stem.stem(x) for x in t] for i, t in rows}
    for step in (1, 8, 64):
        assert {r["i"]: r["s"] for r in df.select("i", stem.stems(F.col("t"), step).alias("s")).collect()} == want


def test_pair_counts_in_parts(spark):
    lists = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "c"]), (3, ["a"])], "s int, entities array<string>")
    for most in (1, 1 << 21):
        assert sorted(tuple(r) for r in relations.pair_counts(lists, most).collect()) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]
