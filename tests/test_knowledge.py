import pytest

from loomwright.operators import knowledge
from loomwright.plans import config
from loomwright.sources import wiki


def test_article():
    a = wiki.article("Die {{Info|[[Berlin|B]]}}[[Audi AG|Audi]] und [[VW]].[[Kategorie:Auto]][[Datei:x.png]]")
    assert a["text"] == "Die Audi und VW."
    assert a["links"] == [("Audi", "Audi AG", 4), ("VW", "VW", 13)]
    assert a["template_links"] == [("B", "Berlin")] and a["categories"] == ["Auto"]
    assert wiki.article("#WEITERLEITUNG [[Ziel]]")["redirect"] == "Ziel"
    assert wiki.article(None)["text"] == ""


def test_parse_articles(spark):
    p = spark.createDataFrame([("A", "x [[B]]"), ("Vorlage:C", "y"), ("D", "REDIRECT [[A]]")], "title string, text string")
    assert [(r["title"], r["text"]) for r in wiki.parse_articles(p).orderBy("title").collect()][0] == ("A", "x B")
    assert [tuple(r) for r in wiki.redirects(p).collect()] == [("D", "A")]


def test_html_text_and_annotation():
    text, links = wiki.html_text('<div>no</div><p>See <a href="/x">this</a><small>no</small> now</p>')
    assert text == "See this now" and links == [("this", "/x", 4)]
    assert wiki.annotate("See this now", [(4, "this", "/x"), (5, "his", "/y")]) == 'See <a href="/x">this</a> now'


def test_find_and_resolve(spark):
    e = spark.createDataFrame([("Q1", {"owner": ["Q2", "x"], "height": ["5;Q3"]}), ("Q9", {})], "id string, properties map<string,array<string>>")
    known = spark.createDataFrame([("Q2", "Two")], "id string, name string")
    assert [tuple(r) for r in knowledge.find_relations(e, known).collect()] == [("Q1", "owner", "Q2", "Two")]
    labels = spark.createDataFrame([("Q2", "Two"), ("Q3", "metre")], "id string, label string")
    assert {r["id"]: r["properties"] for r in knowledge.resolve_entities(e, labels).collect()} == {"Q1": {"owner": ["Two", "x"], "height": ["5;metre"]}, "Q9": {}}


def test_tags_triples_and_relations(spark):
    paths = spark.createDataFrame([("c", ["root", "c"])], "node string, path array<string>")
    e = spark.createDataFrame([("x", ["zz", "c"])], "id string, classes array<string>")
    assert [(r["id"], r["tag"]) for r in knowledge.tag_entities(e, paths).collect()] == [("x", "root")]
    t = spark.createDataFrame([("s", "p", "1"), ("s", "p", "2"), ("s", "q", "3")], "subject string, property string, object string")
    assert knowledge.group_triples(t).first()["properties"] == {"p": ["1", "2"], "q": ["3"]}
    subjects = spark.createDataFrame([("1", "A", {"2": {"old": "1"}}), ("2", "B", {})], "id string, name string, relations map<string,map<string,string>>")
    rel = knowledge.import_relations(spark.createDataFrame([("A", "B", "owns")], "subject string, object string, relation string"), subjects)
    assert [tuple(r) for r in rel.collect()] == [("1", "2", "owns")]
    assert {r["id"]: r["relations"] for r in knowledge.add_relations(subjects, rel).collect()} == {"1": {"2": {"old": "1", "owns": ""}}, "2": {}}


def test_sentences(spark):
    a = spark.createDataFrame([("T", "Audi kauft VW. Allein VW.", [{"alias": "Audi", "page": "Audi AG", "offset": 0}, {"alias": "VW", "page": "VW", "offset": 11}, {"alias": "VW", "page": "VW", "offset": 22}])], "title string, text string, links array<struct<alias:string,page:string,offset:int>>")
    s = knowledge.sentences_with_entities(a)
    assert [(r["start"], r["sentence"], [e["offset"] for e in r["entities"]]) for r in s.collect()] == [(0, "Audi kauft VW.", [0, 11])]
    pages = spark.createDataFrame([("Audi AG",), ("VW",)], "page string")
    assert knowledge.filter_sentence_entities(s, pages, pages.where("false")).count() == 1
    assert knowledge.filter_sentence_entities(s, pages, pages.where("page = 'VW'")).count() == 0


def test_patterns(spark):
    t = spark.createDataFrame([(1, "p"), (2, "p"), (3, None)], "id int, pattern string")
    assert {r["id"]: r["pattern_frequency"] for r in knowledge.pattern_statistics(t).collect()} == {1: 2, 2: 2, 3: 1}


def el(tag, *inside):
    return f"<{tag}>{''.join(inside)}</{tag}>"


def feature(name, *more):
    return el("feature", el("similarityMeasure", name), *more)


XML = el(
    "config",
    el("settings", el("minConfidence", "0.7"), el("t", "a"), el("t", "b")),
    el(
        "simMeasurements",
        el("attribute", el("key", "name"), el("weight", "0.8"), feature("JaroWinkler", el("weight", "0.7")), feature("MongeElkan", el("weight", "0.3"), el("scale", "2"))),
        el("attribute", el("key", "urls"), el("weight", "0.2"), feature("UrlCompare")),
    ),
    el("sectorMapping", el("sector", el("key", "Bau"), el("mapping", "a"), el("mapping", "b"))),
    el("attributeMapping", el("attribute", el("key", "city"), el("mapping", "P1"), el("mapping", "P2"))),
)


def test_config():
    c = config.read(XML)
    assert c.settings == {"minConfidence": "0.7", "t": "b"} and c.mapping == {"city": ["P1", "P2"]} and c.sectors == {"Bau": ["a", "b"]}
    assert c.similarity == {"name": (0.8, [("JaroWinkler", 0.7, 1), ("MongeElkan", 0.3, 2)]), "urls": (0.2, [("UrlCompare", 1.0, 1)])}
    with pytest.raises(ValueError):
        config.read(XML.replace("UrlCompare", "RoughlyEqualNumbers"))
