"""Pipelines over stores of small tables, the command line, and the configurations."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from loomwright.functions import normalise as norm
from loomwright.functions import similarity as sim
from loomwright.operators import aliases, entities, fusion, knowledge, linking, relations, text
from loomwright.plans import config, configs, jobs
from loomwright.sources import dumps, pages, wiki
from loomwright.streaming.windows import windowed_counts

SUBJECT = "id string, master string, datasource string, name string, aliases array<string>, category string, properties map<string,array<string>>, relations map<string,map<string,string>>"


def store(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return jobs.Store(spark, str(path))


def test_wikidata_pipeline(spark, tmp_path):
    value = lambda v: {"mainsnak": {"datavalue": json.dumps({"value": v})}}
    e = lambda id_, label, **claims: json.dumps({"id": id_, "labels": {"de": {"value": label}, "en": {"value": "no"}}, "aliases": {"de": [{"value": label.lower()}]}, "claims": {k: [value(x) for x in v] for k, v in claims.items()}})
    lines = [(e("Q1", "company"),), (e("Q2", "AG", P279=[{"id": "Q1"}]),), (e("Q3", "Audi AG", P31=[{"id": "Q2"}], P1128=[{"amount": "+90", "unit": "1"}], P127=[{"id": "Q4"}]),), (e("Q4", "VW", P31=[{"id": "Q1"}], P452=[{"id": "Q5"}]),), (e("Q5", "Autos"),)]
    s = store(spark, tmp_path, wikidata_lines=(lines, "json string"), wikidata_properties=([("P31", "instance of"), ("P279", "subclass of"), ("P1128", "employees"), ("P127", "owned by"), ("P452", "industry")], "id string, name string"))
    s.flags.root = "Q1"
    s.flags.import_config.mapping = {"gen_employees": ["employees"], "gen_sectors": ["industry"]}
    s.flags.sectors = {"Autos": ["cars", "vehicles"]}
    assert jobs.run(s, "wikidata") == jobs.PIPELINES["wikidata"]
    got = {r["name"]: r for r in s.read("subject_wikidata").collect()}
    assert set(got) == {"Audi AG", "VW"}  # the others have no type
    assert got["Audi AG"]["category"] == "business" and got["Audi AG"]["aliases"] == ["audi ag"]
    assert got["Audi AG"]["properties"]["gen_employees"] == ["90"] and got["Audi AG"]["properties"]["gen_legal_form"] == ["AG"]
    assert got["VW"]["properties"]["gen_sectors"] == ["cars", "vehicles"] and got["VW"]["properties"]["industry"] == ["Autos"]


def test_dbpedia_pipeline(spark, tmp_path):
    t = [("r:A", "rdf:type", "owl:Thing"), ("r:A", "rdf:type", "dbo:Company"), ("r:A", "rdfs:label", "Audi@de ."), ("r:V", "rdf:type", "dbo:Company"), ("r:V", "rdfs:label", "VW@de ."), ("r:A", "dbo:owner", "r:V"), ("r:A", "owl:sameAs", "dbpedia-de:Audi"), ("r:V", "owl:sameAs", "dbpedia-de:VW"), ("r:X", "rdfs:label", "X")]
    s = store(spark, tmp_path, dbpedia_triples=(t, "subject string, property string, object string"))
    jobs.run(s, "dbpedia")
    got = {r["name"]: r for r in s.read("subject_dbpedia").collect()}
    assert set(got) == {"Audi", "VW"} and got["Audi"]["relations"] == {got["VW"]["id"]: {"owner": ""}}


PAGE = '<div class="addressCoordinates">Bauhofstr. 3 12345 Alt Ort Deutschland</div><div class="employees"><ul><li><p>a</p></li><li><p>b</p><p>Von 10 bis 19 Beschäftigte</p></li></ul></div><div class="turnover"><ul><li><p>x</p><p>5 Millionen EUR</p></li></ul></div><div id="executives"><b class="name">A B</b></div><div class="general bloc"><ul class="presentation global"><li><p>Rechtsform</p><p>GmbH</p></li><li><p>leer</p><p></p></li></ul></div><div id="secondaryActivitiesTree"><a>"Bau"</a></div>'


def test_kompass_pipeline(spark, tmp_path):
    s = store(spark, tmp_path, kompass_pages=([("Bau GmbH", PAGE, "http://k/1")], "name string, html string, url string"))
    s.flags.import_config.mapping = {"geo_street": ["address"], "geo_postal": ["address"], "geo_city": ["address"], "gen_employees": ["employees"], "gen_turnover": ["turnover"]}
    jobs.run(s, "kompass")
    p = s.read("subject_kompass").first()["properties"]
    assert (p["geo_street"], p["geo_postal"], p["geo_city"]) == (["Bauhofstraße 3"], ["12345"], ["Alt Ort"])
    assert (p["gen_employees"], p["gen_turnover"], p["gen_legal_form"], p["url"], p["activities"]) == (["10", "19"], ["5000000"], ["GmbH"], ["http://k/1"], ["Bau"])


def test_resolution_pipeline(spark, tmp_path):
    none = {}
    subjects = [("m1", "m1", "master", "Audi AG", [], None, none, {"s1": {"slave": "1.0"}}), ("s1", "m1", "wikidata", "Audi AG", [], "business", {"gen_urls": ["http://www.audi.de"]}, {"m1": {"master": "1.0"}})]
    staging = [("k1", None, "kompass", "Audi Ag", ["Auto Union"], None, {"gen_urls": ["http://audi.de"], "gen_employees": ["9"]}, none), ("k2", None, "kompass", "Bosch", [], "business", none, none)]
    s = store(spark, tmp_path, subject=(subjects, SUBJECT), staging=(staging, SUBJECT))
    s.flags.config.settings = {"resolution": "wikidata"}
    jobs.run(s, "resolution")
    found = s.read("duplicates").collect()
    assert [(r["subject"], r["staging"]) for r in found] == [("s1", "k1")] and found[0]["score"] >= 0.9
    got = {r["id"]: r for r in s.read("subject").collect()}
    assert set(got) == {"m1", "s1", "k1", "k2", "master-k2"}
    assert got["k1"]["master"] == "m1" and set(got["k1"]["relations"]["s1"]) == {"isDuplicate"}
    assert got["m1"]["name"] == "Audi Ag" and got["m1"]["aliases"] == ["Audi AG", "Auto Union"] and got["m1"]["properties"]["gen_employees"] == ["9"] and got["m1"]["category"] == "business"
    assert got["master-k2"]["name"] == "Bosch" and got["master-k2"]["relations"] == {"k2": {"slave": "1.0"}}
    assert {r["value"].split(",")[0] for r in s.read("export").where("kind = 'node'").collect()} == {'"m1"', '"master-k2"'}


def test_commit_pipeline(spark, tmp_path):
    rows = [("m1", "m1", "master", "A", [], None, {"x": ["1"]}, {"s2": {"owner": ""}}), ("s1", "m1", "wikidata", "A", [], None, {"x": ["1"]}, {"s2": {"owner": ""}, "m1": {"master": "1.0"}}), ("m2", "m2", "master", "B", [], None, {}, {}), ("s2", "m2", "wikidata", "B", [], None, {}, {"m2": {"master": "0.5"}})]
    s = store(spark, tmp_path, subject=(rows, SUBJECT))
    s.flags.commit = {"created": {"n1": {"name": "New", "properties": {"x": "2; 3"}}}, "updated": {"m1": {"name": "A2", "properties": {"x": ["7"]}}}, "deleted": {"m2": {}}}
    jobs.run(s, "commit")
    got = {r["id"]: r for r in s.read("subject").collect()}
    assert set(got) == {"m1", "s1", "m2", "s2", "n1", "master-n1", "human-m1", "human-m2"}
    assert got["m1"]["name"] == "A2" and got["m1"]["aliases"] == ["A"] and got["m1"]["properties"]["x"] == ["7"]
    assert got["master-n1"]["properties"]["x"] == ["2", "3"] and got["m2"]["properties"]["deleted"] == ["true"]
    assert got["m1"]["relations"]["m2"] == {"owner": ""} and set(got["m1"]["relations"]) == {"m2", "s1", "human-m1"}
    lines = {r["value"] for r in s.read("export").collect()}
    assert "m1,m2,owned by" in lines and not any(x.startswith('"m2"') for x in lines)


def test_textmining_pipeline(spark, tmp_path):
    filler = " ".join(f"wort{i}" for i in range(30))
    wiki = [("Audi AG", f"Die [[VW|Volkswagen]] Tochter Audi baut Autos. {filler}"), ("VW", f"VW baut in [[Wolfsburg]] Autos. {filler}"), ("Volkswagen", "REDIRECT [[VW]]"), ("Wolfsburg", f"In Wolfsburg sitzt [[Volkswagen]]. Und [[Audi AG|Audi]]. [[Fehlt]] [[Kategorie:Stadt]] {filler}"), ("Wagen", f"Ein [[VW|Volkswagen]] ist ein Wagen. [[Wagen|Volkswagen]] {filler}"), ("Vorlage:X", "[[VW]]")] + [(f"A{i}", f"Artikel {i} nennt [[VW]] und [[Audi AG|Audi]] {filler}") for i in range(8)]
    entities_ = [("Q1", "company", "VW"), ("Q2", "company", "Audi AG"), ("Q3", None, "Wolfsburg")]
    s = store(spark, tmp_path, wikipedia=(wiki, "title string, text string"), wikidata=(entities_, "id string, instancetype string, wikiname string"))
    jobs.run(s, "textmining")
    links = {(r["doc_id"], r["alias"], r["page"], r["reduced"]) for r in s.read("links").collect()}
    assert ("Wolfsburg", "Volkswagen", "VW", True) in links and ("VW", "Wolfsburg", "Wolfsburg", False) in links and ("Wolfsburg", "Stadt", "Stadt", False) in links
    assert not any(p in ("Fehlt", "Volkswagen") for _, _, p, _ in links)
    assert ("Audi AG", "Audi") in {(r["doc_id"], r["alias"]) for r in s.read("extended_links").collect()}
    pages_ = {(r["alias"], r["page"]) for r in s.read("alias_pages").collect()}
    assert {("Volkswagen", "VW"), ("Volkswagen", "Wagen"), ("VW", "VW"), ("Audi", "Audi AG")} <= pages_
    occ = {r["alias"]: (r["links"], r["total"]) for r in s.read("alias_occurrences").collect()}
    assert occ["Audi"] == (9, 10) and occ["Wolfsburg"][0] == 1 and occ["Wolfsburg"][1] >= 2
    f = s.read("features_with_ranks").collect()
    assert {(r["alias"], r["entity"]) for r in f} >= {("Volkswagen", "Wagen"), ("Volkswagen", "VW")}
    assert max(r["entity_rank"] for r in f if r["alias"] == "Volkswagen") == 2 and all(0 <= r["cosine"] <= 1 for r in f)
    assert s.read("nel_statistics").count() == 1
    got = {(r["doc_id"], x["alias"], x["entity"]) for r in s.read("found_entities").collect() for x in r["links"]}
    assert ("A1", "Audi", "Audi AG") in got and ("A1", "VW", "VW") in got


def test_jobs_name_what_is_missing(spark, tmp_path):
    s = jobs.Store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="wikidata_lines"):
        jobs.run(s, "wikidata")
    with pytest.raises(ValueError, match="no job"):
        jobs.run(s, "nothing")
    assert {j for p in jobs.PIPELINES.values() for j in p} <= set(jobs.JOBS)


def test_queries_are_jobs(spark, tmp_path):
    s = store(spark, tmp_path, supplier=([(1, "S", 2)], "s_suppkey long, s_name string, s_nationkey int"))
    assert jobs.run(s, "csv_nodes") == ["csv_nodes"] and s.read("csv_nodes").count() == 1


def test_command_line(tmp_path):
    (tmp_path / "c.xml").write_text("<config><settings><minConfidence>0.5</minConfidence></settings></config>")
    code = base64.b64encode(b'{"created": {}}').decode()
    f = jobs.flags(jobs.parser().parse_args(["s", "commit", "-c", str(tmp_path / "c.xml"), "-j", code, "-t", "words", "true", "-r", "-d", "1", "2", "-b", "why", "--sources", "b", "a"]))
    assert (f.config.settings, f.commit, f.tokenizer, f.reduced, f.diff_versions, f.comment, f.sources) == ({"minConfidence": "0.5"}, {"created": {}}, ("words", "true"), True, ("1", "2"), "why", ("b", "a"))
    assert jobs.json_argument('{"a": 1}') == {"a": 1}
    with pytest.raises(ValueError):
        jobs.json_argument("not base 64!")
    with pytest.raises(ValueError):
        jobs.flags(jobs.parser().parse_args(["s", "j", "-t", "a", "b", "c", "d"]))


def test_versions_by_jobs(spark, tmp_path):
    v = [("1", "a"), ("3", "b")]
    s = store(spark, tmp_path, subject_history=([("x", "b", v), ("y", "z", v[:1])], "id string, name string, name_history array<struct<version:string,value:string>>"))
    s.flags.diff_versions = ("1", "3")
    jobs.run(s, "version_diff")
    assert [(r["id"], r["name"]) for r in s.read("version_diff").collect()] == [("x", '{"+":["b"],"-":["a"]}')]
    s.flags.restore_version = "2"
    jobs.run(s, "version_restore")
    assert {r["id"]: r["name"] for r in s.read("subject_history").collect()} == {"x": "a", "y": "a"}


# ---------------------------------------------------------------- configurations


def best(spark, name, a, b, pa=None, pb=None):
    df = spark.createDataFrame([(a, pa or {}, b, pb or {})], "s_name string, s_properties map<string,array<string>>, t_name string, t_properties map<string,array<string>>")
    return df.select(configs.pair_score(configs.RESOLUTIONS[name]).alias("x")).first()["x"]


def test_what_the_configurations_lead_to(spark):
    r = configs.RESOLUTIONS
    url, ids = {"gen_urls": ["http://www.a.de/"]}, {"id_wikidata": ["Q1"]}
    name_alone, one_id, no_urls, no_url = best(spark, "kompass_strict", "A B", "A B"), best(spark, "dbpedia", "Xyz", "Abc", ids, ids), best(spark, "kompass", "Audi", "Audi"), best(spark, "wikidata", "Audi", "Audi")
    assert [name_alone, one_id, no_urls, no_url] == pytest.approx([0.6, 0.3333, 0.5, 0.8])
    assert name_alone < r["kompass_strict"].confidence and one_id > r["dbpedia"].confidence and no_urls > r["kompass"].confidence and no_url < r["wikidata"].confidence
    assert best(spark, "wikidata", "Audi", "Audi", url, {"gen_urls": ["http://a.de"]}) == pytest.approx(1.0)
    assert best(spark, "evaluation", "Audi", "Audi", {"geo_country": ["DE"]}, {"geo_country": ["de", "FR"]}) == pytest.approx(1.0)
    assert best(spark, "fuzzy_nel", "Audi AG", "audi ag") == pytest.approx(1.0)
    assert r["dbpedia"].similarity()["name"] == (0.3333, [("JaroWinkler", 0.7, 1), ("MongeElkan", 0.3, 1)])


def test_resolution_of_a_file():
    c = config.Config({"minConfidence": "0.4", "stagingTable": "t"}, {"name": (1.0, [("Jaccard", 1.0, 1)])})
    r = configs.of(c)
    assert (r.confidence, r.staging, r.similarity()) == (0.4, "t", {"name": (1.0, [("Jaccard", 1.0, 1)])})


def test_strategies(spark):
    xs, ys = F.array(F.lit("A"), F.lit("b")), F.array(F.lit("a"), F.lit("c"))
    x = lambda name: spark.range(1).select(sim.strategy(name)(xs, ys, sim.exact).alias("x")).first()["x"]
    assert (x("name"), x("category"), x("other")) == (0.5, 0.0, 0.0)


# ---------------------------------------------------------------- pages, exports, edits


def test_pages():
    html = '<html><head><title>T</title></head><body><div class="dig-artikel x">A&nbsp;<b>b</b></div><div>n</div></body></html>'
    assert pages.news_text(html) == "T A b" and pages.news_text(html.replace("dig-artikel x", "other")) == "T A b n" and pages.news_text(None) == ""
    assert pages.list_links("<ul><li><a href=/a>A</a> x <a href=/b>B</a><li><a href=/c>C</a></ul>") == [("A", "/a"), ("C", "/c")]
    assert pages.linked_files('<a href="/x.ttl.bz2">x.ttl</a><a href="/en_uris.ttl">y.ttl</a><a href="/z">z</a>', "ttl", "en_uris") == ["/x.ttl.bz2"]


def test_wiki_predicates_and_disambiguations(spark):
    f = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert f(wiki.clean_redirect(F.lit("#WEITERLEITUNG\u00a0[[Ziel]]"))) == "[[Ziel]]" and f(wiki.is_category_link(F.lit("a"), F.lit("Kategorie:B")))
    assert f(norm.unit_id(F.lit("5;Q11"))) and not f(norm.unit_id(F.lit("Q11")))
    a = wiki.parse_articles(spark.createDataFrame([("M", "[[A]] oder [[B]] {{Begriffsklärung}}"), ("N", "[[A]]")], "title string, text string"))
    assert {(r["doc_id"], r["kind"], r["page"]) for r in jobs._links(a).collect()} == {("M", "disambiguation", "A"), ("M", "disambiguation", "B"), ("N", "text", "A")}


def test_mentions_that_are_not_links(spark):
    found = spark.createDataFrame([(1, "a", 0), (1, "b", 3), (1, "--", 5), (1, "The", 7)], "doc_id int, alias string, pos int")
    links = spark.createDataFrame([(1, 0), (2, 3)], "doc_id int, pos int")
    assert [tuple(r) for r in aliases.unlinked(found, links, ("the",)).select("doc_id", "alias", "pos").collect()] == [(1, "b", 3)]


def test_bags_of_pairs_and_collections(spark, tmp_path):
    s = spark.createDataFrame([("x|y", ["a", "b", "a"]), ("x|y", ["b"]), ("y|z", [])], "pair string, bag array<string>")
    assert {tuple(r) for r in relations.pair_bags(s).collect()} == {("x|y", "a", 2), ("x|y", "b", 2)}
    (tmp_path / "stop.txt").write_text("der\n# note\nDie\n")
    c = dumps.collection(spark, str(tmp_path / "stop.txt"), F.lower, lambda v: ~v.startswith("#"))
    assert {r["value"] for r in c.collect()} == {"der", "die"}


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(["a", "b"],), ([],)], "t array<string>")
    pages.write_tokens(d, "t", str(tmp_path / "t"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["", "a\tb"]
    path = pages.write_stamped(d.select(F.lit("x").alias("value")), str(tmp_path), "edges", "20200101")
    assert path.endswith("edges_20200101") and spark.read.text(path).count() == 2
    n = pages.numbered_sentences(spark.createDataFrame([(i,) for i in (5, 3, 9)], "x int").repartition(3), ["x"])
    assert {r["x"]: r["index"] for r in n.collect()} == {3: 0, 5: 1, 9: 2}


def test_edits(spark):
    f = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    rel = F.create_map(F.lit("m"), F.create_map(F.lit("master"), F.lit("0.5"), F.lit("near"), F.lit("")))
    assert f(fusion.change_master(rel, F.lit("m"), F.lit("n"), F.lit(0.7))) == {"m": {"near": ""}, "n": {"master": "0.7"}}
    assert f(fusion.change_master(rel, F.lit("m"), F.lit("m"), F.lit(0.3))) == {"m": {"master": "0.5", "near": ""}}
    assert f(fusion.remove_relation(rel, "near")) == {"m": {"master": "0.5"}}
    assert f(fusion.split_values(F.lit("a; b;;c "))) == ["a", "b", "c"] and f(fusion.split_values(F.lit(None).cast("string"))) == []
    assert f(entities.slaves(F.create_map(F.lit("b"), F.create_map(F.lit("slave"), F.lit("1"))))) == ["b"]
    assert f(norm.json_double(F.lit('{"a": "x"}'), "$.a")) is None
    log = fusion.version_log(spark.createDataFrame([], "version string, program string, datasources array<string>, ts timestamp"), "job", ["a"], F.lit("2020-01-01").cast("timestamp"))
    assert fusion.version_log(log, "job", ["a"], F.lit("2020-01-02").cast("timestamp")).select("version").distinct().count() == 2


def test_sentences_keep_their_characters(spark):
    t = spark.createDataFrame([("0 zero. 1 one!\n\n2 two? three 3",)], "t string")
    assert t.select(text.sentences(F.col("t")).alias("x")).first()["x"] == ["0 zero.", "1 one!", "2 two?", "three 3"]


def test_unwanted_pages(spark):
    rel = spark.createDataFrame([("A", "city", "Ulm"), ("A", "owner", "B")], "subject string, relation string, object string")
    assert {r["page"] for r in knowledge.unwanted_pages(rel, spark.createDataFrame([("Konzern",)], "page string")).collect()} == {"Ulm", "Konzern"}


def test_relation_names(spark):
    s = spark.createDataFrame([("1", {"2": {"owner": "", "owningCompany": "", "x": ""}, "3": {"master": ""}})], "id string, relations map<string,map<string,string>>")
    assert [r["value"] for r in dumps.relation_lines(s).collect()] == ["1,2,owned by"]


def test_windows_of_a_stream_equal_those_of_a_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "event_type", "value")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = windowed_counts(stream, late="3650 days").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
    q.awaitTermination()
    rows = lambda df: sorted((r["event_type"], r["start"], r["n"], round(r["total"], 3)) for r in df.collect())
    assert rows(spark.table("windows")) == rows(windowed_counts(events)) != []


def test_unknown_sources_raise():
    with pytest.raises(ValueError):
        entities.normalise("nowhere", "x", F.lit(None))


def test_decisions_by_folds(spark):
    rows = [(i, 0, "a", f"e{j}", 0.5, 0.9 if j == i % 2 else 0.1, 0.8 if j == i % 2 else 0.0, int(j == i % 2)) for i in range(60) for j in (0, 1)]
    f = linking.composite_features(spark.createDataFrame(rows, "doc_id int, pos int, alias string, entity string, link_score double, entity_score double, cosine double, label int"))
    assert all(r["prediction"] == r["label"] for r in linking.cross_decide(f).collect())
