"""Fixed values."""

import math

import pytest
from pyspark.sql import functions as F

from loomwright.functions import bags, stem
from loomwright.functions import normalise as norm
from loomwright.functions import similarity as sim
from loomwright.operators import aliases, blocking, embeddings, graph, relations, resolution, text, versions
from loomwright.sources import dumps


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


GOLDEN = """
Jaccard:apple:applet:0.8333333333333334
Jaccard:string:gnirts:1
Jaccard:a:b:0
DiceSorensen:night:nachts:0.5454545454545454
DiceSorensen:context:contact:0.7142857142857143
NGram:nacht:night:0.6
Overlap:nacht:night:0.6
Jaro:dwayne:duane:0.8222222222222223
Jaro:jones:johnson:0.7904761904761904
Jaro:fvie:ten:0
JaroWinkler:dwayne:duane:0.84
JaroWinkler:jones:johnson:0.8323809523809523
MongeElkan:Peter Christen:Christian Pedro:0.8586111111111111
MongeElkan:paul johnson:johson paule:0.9438888888888889
EuclidianDistance:52;11:52;11:1
EuclidianDistance:52;11:52;13:0.5
EuclidianDistance:52;11:53;14:0
"""


@pytest.mark.parametrize("line", GOLDEN.split("\n")[1:-1])
def test_similarity(spark, line):
    name, a, b, want = line.split(":")
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(sim.measure(name)(F.col("a"), F.col("b")).alias("x")).first()["x"] == pytest.approx(float(want), abs=1e-12)


def test_url(spark):
    assert one(spark, sim.url(F.lit("http://www.a.de/x"), F.lit("https://a.de"))) == 1.0


def test_unknown_measure_raises():
    with pytest.raises(ValueError):
        sim.measure("RoughlyEqualNumbers")


def test_geo_scores(spark):
    for scale, want in ((1, [1, 1, 0.75, 0.5, 0]), (2, [1, 1, 1, 0.75, 0])):
        assert [one(spark, sim.geo_score(F.lit(float(d)), scale)) for d in (0, 1, 5.1, 21, 312)] == want


def test_weights():
    assert sim.normalise_weights({"a": 0, "b": 0, "c": 0}) == {"a": 0.3333, "b": 0.3333, "c": 0.3333}
    assert sim.normalise_weights({"a": 6, "b": 2, "c": 2, "d": 0}) == {"a": 0.6, "b": 0.2, "c": 0.2}


def test_missing_attributes_arent_shared_out(spark):
    df = spark.createDataFrame([("x", "x", None, "y")], "a string, b string, c string, d string")
    score = sim.weighted_score([(F.col("a"), F.col("b"), 0.6, [("ExactMatchString", 1.0, 1)]), (F.col("c"), F.col("d"), 0.4, [("ExactMatchString", 1.0, 1)])])
    assert df.select(score.alias("s")).first()["s"] == pytest.approx(0.6)


def test_second_order(spark):
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate(map(float, "5.0 7.1 5.0 2.9 7.1".split()))], "g int, k int, v double")
    got = sorted((r["k"], r["rank"], round(r["delta_top"], 3), round(r["delta_successor"], 3)) for r in text.second_order(rows, ["g"], "v").collect())
    assert got == [(0, 3, 2.1, 2.1), (1, 1, math.inf, 2.1), (2, 3, 2.1, 2.1), (3, 5, 4.2, math.inf), (4, 1, math.inf, 2.1)]


def test_redirects(spark):
    e = spark.createDataFrame([("1", "3"), ("3", "6"), ("4", "5"), ("5", "4"), ("7", "7"), ("EU", "Europäische Union")], "src string, dst string")
    assert {(r["src"], r["dst"]) for r in aliases.resolve_redirects(e).collect()} == {("1", "6"), ("3", "6"), ("EU", "Europäische Union")}


def test_blocking_keys(spark):
    df = spark.createDataFrame([("Audi AG",), ("The Volkswagen",), ("Ford",)], "name string")
    assert [r["k"][0] for r in df.select(blocking.simple(F.col("name")).alias("k")).collect()] == ["audi ", "volks", "ford"]
    assert [r["k"][0] for r in df.select(blocking.last_letters(F.col("name")).alias("k")).collect()] == ["di ag", "wagen", "ford"]
    assert sorted(one(spark, blocking.geo_grid(F.lit(52.15), F.lit(11.55)))) == ["52.1;11.5", "52.1;11.6", "52.2;11.5", "52.2;11.6"]
    assert one(spark, blocking.mapped(F.array().cast("array<string>"), F.upper)) == ["undefined"]


@pytest.mark.parametrize(("left", "right", "most"), [(23, 7, 30), (3, 50, 10), (40, 40, 7), (5, 5, 1), (1, 9, 4)])
def test_block_split_covers_all_pairs(spark, left, right, most):
    m = spark.createDataFrame([("t", "k", side, i) for side, n in (("subject", left), ("staging", right)) for i in range(n)], "tag string, key string, side string, id int")
    parts = blocking.split(m, most).collect()
    by = {}
    for r in parts:
        by.setdefault(r["part"], {"subject": set(), "staging": set()})[r["side"]].add(r["id"])
    pairs = [(a, b) for p in by.values() for a in p["subject"] for b in p["staging"]]
    assert sorted(pairs) == sorted((a, b) for a in range(left) for b in range(right))
    assert max(len(p["subject"]) * len(p["staging"]) for p in by.values()) <= most


@pytest.mark.parametrize("most", [4, 1 << 20])
def test_pairs_of_blocks_are_in_their_first_block(spark, most):
    rows = [(i, f"n{i % 4}", f"p{i % 3}" if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, name string, postal string")
    schemes = {"name": F.array("name"), "postal": F.array("postal")}
    got = [(r["s_id"], r["t_id"]) for r in blocking.block_pairs(df.where("id < 30"), df.where("id >= 30"), (schemes, schemes), most).collect()]
    want = [(a, b) for a, n, p in rows[:30] for b, m, q in rows[30:] if n == m or (p is not None and p == q)]
    assert sorted(got) == sorted(want)


def test_tf_idf(spark):
    tf = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "doc_id int, term string, tf int")
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 3)], "term string, df int")
    got = {r["term"]: r["tfidf"] for r in text.tf_idf(tf, df, 3).collect()}
    assert got == pytest.approx({"a": 0.47712125471966244, "b": 0.9542425094393249, "c": 0.0})


def test_context(spark):
    t = F.array(*[F.lit(f"t{i}") for i in range(10)])
    assert one(spark, text.context(t, F.lit(4), F.lit(2), 2)) == ["t2", "t3", "t6", "t7"]
    assert one(spark, text.context(t, F.lit(1), F.lit(1), 3)) == ["t0", "t2", "t3", "t4"]


def test_dictionaries_as_trie_and_as_join(spark):
    docs = spark.createDataFrame([(1, "a b c d a b x".split()), (2, ["b", "c"]), (3, []), (4, None)], "doc_id int, tokens array<string>")
    known = spark.createDataFrame([("a",), ("a b",), ("b c d",), ("c  d",), ("b",), ("",), (None,), ("zz",)], "alias string")
    for everything in (False, True):
        trie, join = ({tuple(r) for r in aliases.search(docs, known, everything=everything, limit=n).collect()} for n in (1 << 20, 0))
        assert trie == join and trie
    assert trie >= {(1, "a", 0), (1, "a b", 0), (1, "b c d", 1), (1, "c d", 2), (2, "b", 0)}


def test_stems():
    for word, want in {"abschließen": "abschliess", "abschließender": "abschliess", "Häuser": "hau", "singt": "sing", "singen": "sing", "beliebt": "belieb", "schön": "schon", "gegessen": "gess", "x1": "x1"}.items():
        assert stem.stem(word) == want, word


def test_tokenizers(spark):
    t = F.lit("The Häuser, the singen!")
    assert one(spark, text.tokenizer(["words", "false", "true"])(t)) == ["the", "hau", "the", "sing"]
    assert one(spark, text.tokenizer(["clean", "true", "false"])(t, ("the",))) == ["The", "Häuser", "singen"]
    for bad in (["none"], ["words", "true", "true", "true"]):
        with pytest.raises(ValueError):
            text.tokenizer(bad)


def test_bags(spark):
    a, b = bags.of(F.array(*map(F.lit, "aabc"))), bags.of(F.array(*map(F.lit, "bcd")))
    assert one(spark, bags.plus(a, b)) == {"a": 2, "b": 2, "c": 2, "d": 1} and one(spark, bags.minus(a, b)) == {"a": 2}
    assert one(spark, bags.normalise(a)) == {"a": 1.0, "b": 0.5, "c": 0.5} and one(spark, bags.size(a)) == 4
    assert one(spark, bags.add(a, F.lit("z"), 2))["z"] == 2 and "b" not in one(spark, bags.remove(a, F.lit("b")))


def test_undefined_scores_are_kept(spark):
    c = spark.createDataFrame([(0, 0, 0), (1, 1, 0)], "tp long, fp long, fn long")
    r = resolution.precision_recall(c, undefined=float("nan")).collect()
    assert math.isnan(r[0]["precision"]) and math.isnan(r[0]["f1"]) and r[1]["precision"] == 0.5 and r[1]["recall"] == 1.0


def test_trie():
    t = aliases.Trie([["a"], ["a", "b"], ["a", "b", "c"], ["x", "y"]])
    assert t.contains(["a", "b"]) and not t.contains(["x"]) and t.has_prefix(["x"])
    assert t.matches(["a", "b", "z"]) == [1, 2]
    assert aliases.longest_matches(t, ["q", "a", "b", "c", "x", "y"]) == [(1, 3), (4, 2)]
    assert t.remove(["x", "y"]) and not t.has_prefix(["x"]) and not t.remove(["x", "y"])


def test_extended_link(spark):
    m = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    assert one(spark, aliases.extended_link(m({"p": 1}))) == "p"
    assert one(spark, aliases.extended_link(m({"p": 50, "q": 1}))) == "p"
    assert one(spark, aliases.extended_link(m({"p": 5, "q": 4}))) is None


def test_alias_occurrences(spark):
    links = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "doc_id int, alias string")
    found = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "c")], "doc_id int, alias string")
    assert {tuple(r) for r in aliases.alias_occurrences(links, found).collect()} == {("a", 2, 3), ("b", 1, 1), ("c", 0, 1)}


def test_versions(spark):
    v = F.array(*[F.struct(F.lit(x).alias("version"), F.lit(y).alias("value")) for x, y in (("1", "a"), ("3", "b"))])
    assert one(spark, versions.version_in(v, F.lit("2")))["value"] == "a"
    assert one(spark, versions.version_in(v, F.lit("3")))["value"] == "b"
    assert one(spark, versions.version_in(v, F.lit("0"))) is None
    a = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    assert one(spark, versions.diff(a("a", "b"), a("b", "c"))) == '{"+":["c"],"-":["a"]}'
    assert one(spark, versions.diff(a("a"), a("a"))) is None
    assert one(spark, norm.uuid_millis(F.lit("1b21dd21-3814-1000-8000-000000000000"))) is not None


def test_commit(spark):
    s = spark.createDataFrame([(1, "dbpedia", "A", {"p": ["x"]}), (2, "human", "B", {"p": ["y"], "q": ["z"]})], "id int, datasource string, name string, properties map<string,array<string>>")
    c = spark.createDataFrame([(1, "delete", None, None), (2, "update", None, {"p": ["new"]}), (3, "create", "C", {})], "id int, action string, name string, properties map<string,array<string>>")
    got = {(r["id"], r["datasource"]): (r["name"], r["properties"]) for r in versions.apply_commit(s, c).collect()}
    assert got == {(1, "dbpedia"): ("A", {"p": ["x"]}), (1, "human"): (None, {"deleted": ["true"]}), (2, "human"): ("B", {"p": ["new"], "q": ["z"]}), (3, "human"): ("C", {})}


def test_append_map(spark):
    b = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"c": "3"})], "k int, m map<string,string>")
    d = spark.createDataFrame([(1, {"b": "9", "z": "0"})], "k int, m map<string,string>")
    assert {r["k"]: r["m"] for r in resolution.append_maps(b, d, "k", "m").collect()} == {1: {"a": "1", "b": "9", "z": "0"}, 2: {"c": "3"}}


def test_normalisers(spark):
    f = lambda c: one(spark, c)
    assert f(norm.legal_form(F.lit("Foo GmbH & Co. KG"))) == "GmbH & Co. KG" and f(norm.legal_form(F.lit("Foo"))) is None
    assert f(norm.country_code(F.lit("Deutschland"))) == "DE"
    assert tuple(f(norm.number_range(F.lit("100 - 1.499 Mitarbeiter")))) == (100, 1499)
    assert tuple(f(norm.address(F.lit("Weg 1, 12345 Ort")))) == ("Weg 1", "12345", "Ort")
    assert f(norm.url_decode(F.lit("/A%20b_c+d%zz"))) == "A b c+d%zz"
    assert f(norm.map_attributes(F.create_map(F.lit("p1"), F.array(F.lit("x"))), {"a": ["p1", "p2"], "b": ["p3"]})) == {"a": ["x"]}
    assert f(norm.clean_triple(F.lit('<http://x/a> <http://x/b> "c" .')))[:2] == ["http://x/a", "http://x/b"]
    assert f(norm.clean_triple(F.lit('<http://x/a> <http://x/b> "c"@de .'), {"http://x/": "x:"}, "@de$"))[:2] == ["x:a", "x:b"]
    assert f(norm.legal_forms(F.array(*map(F.lit, ["Verein", "Foo gmbh &Co KG", "x e. V.", "Gewerbe", "SE"])))) == ["e.V.", "GmbH & Co. KG", "Gewerbe", "SE"]
    assert f(norm.country_code(F.lit("Ungarn"))) == "HU" and f(norm.country_code(F.lit("Nirgendwo"))) is None


def test_sources(spark, tmp_path):
    (tmp_path / "d.json").write_text('[\n{"id": "Q1"},\n\n{"id": "Q2"}]\n')
    assert [r["id"] for r in dumps.json_array_lines(spark, str(tmp_path / "d.json"), "id string").collect()] == ["Q1", "Q2"]
    (tmp_path / "d.xml").write_text("<w><page><title>T</title><revision><text>x</text></revision></page><page><title>U</title><revision><text>y</text></revision></page></w>")
    assert {(r["title"], r["text"]) for r in dumps.xml_pages(spark, str(tmp_path / "d.xml")).collect()} == {("T", "x"), ("U", "y")}
    (tmp_path / "v").write_text("w 1.0 2.0\nshort 1\n")
    assert [(r["word"], r["vector"]) for r in dumps.word_vectors(spark, str(tmp_path / "v")).collect()] == [("w", [1.0, 2.0])]


def test_graph(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "src int, dst int")
    assert {r["component"] for r in graph.components(chain).collect()} == {0, 100}
    groups = graph.component_groups(chain)
    assert sorted((r["component"], r["size"], r["id"], r["degree"]) for r in groups.collect()) == [(0, 61, i, 1 if i in (0, 60) else 2) for i in range(61)]
    assert [(r["size"], r["nodes"][-2:], r["type"]) for r in graph.result_graphs(groups, "chain").collect()] == [(61, [0, 60], "chain")]
    owned = chain.withColumn("relation", F.when(F.col("src") < 5, "owns").when(F.col("src") < 30, "knows").otherwise("part of"))
    assert {(r["component"], r["size"]) for r in graph.ownership_groups(owned, ("owns", "part of")).collect()} == {(0, 6), (30, 31)}
    assert graph.components(chain.where("src < 0")).count() == 0


def test_relations(spark):
    rows = spark.createDataFrame([(1, "Audi"), (1, "VW"), (2, "VW"), (2, "Audi"), (3, "X")], "s int, e string")
    lists = relations.entity_lists(rows, "s", "e")
    assert [(r["entities"], r["n"]) for r in relations.cooccurrences(lists).collect()] == [(["Audi", "VW"], 2)]
    assert [tuple(r) for r in relations.pair_counts(lists).collect()] == [("Audi", "VW", 2)]


def test_first_component(spark):
    rows = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(1, 6)], "id int, v array<double>")
    v = embeddings.first_component(rows, "v")
    left = rows.select(embeddings.remove_component(F.col("v"), v).alias("x")).collect()
    assert max(abs(c) for r in left for c in r["x"]) < 1e-9


def test_sentence_embedding(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "zz")], "id int, word string")
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [10.0, 0.0])], "word string, vector array<double>")
    w = spark.createDataFrame([("b", 0.5)], "word string, weight double")
    assert [(r["id"], r["embedding"]) for r in embeddings.sentence_embeddings(t, v, w).collect()] == [(1, [6.0, 2.0])]
