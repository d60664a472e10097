"""Operators on imported entities: relations among them, labels for ids, classes, datasource triples, sentences with links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocking


def find_relations(entities: DataFrame, known: DataFrame) -> DataFrame:
    """(src, property, dst, name): property values of (id, properties) that are ids of ``known`` (id, name)."""
    v = entities.select(F.col("id").alias("src"), F.explode("properties").alias("property", "values")).select("src", "property", F.explode("values").alias("dst"))
    return v.join(known.select(F.col("id").alias("dst"), "name"), "dst").select("src", "property", "dst", "name").distinct()


def resolve_entities(entities: DataFrame, labels: DataFrame) -> DataFrame:
    """``properties`` with ids, and ids of units after a semicolon, replaced by labels (id, label); unknown ones stay."""
    v = entities.select("id", F.explode("properties").alias("property", "values")).select("id", "property", F.posexplode("values").alias("i", "value"))
    ref = F.regexp_extract("value", r"(?:^|;)([PQ][0-9]+)$", 1)
    v = v.withColumn("ref", F.when(ref != "", ref)).join(labels.select(F.col("id").alias("ref"), "label"), "ref", "left")
    v = v.withColumn("value", F.when(F.col("label").isNotNull(), F.concat(F.regexp_replace("value", r"[PQ][0-9]+$", ""), F.col("label"))).otherwise(F.col("value")))
    lists = v.groupBy("id", "property").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda x: x["value"]).alias("values"))
    maps = lists.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("property", "values")))).alias("properties"))
    rest = [c for c in entities.columns if c not in ("id", "properties")]
    return entities.select("id", *rest).join(maps, "id", "left").select("id", *rest, F.coalesce("properties", F.create_map().cast("map<string,array<string>>")).alias("properties"))


def tag_entities(entities: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, tag, path): each of (id, classes) by its first class that has a path (node, path) from a root."""
    c = entities.select("id", F.posexplode("classes").alias("i", "node")).join(paths, "node")
    return c.groupBy("id").agg(F.min_by(F.struct("node", "path"), "i").alias("t")).select("id", F.element_at("t.path", 1).alias("tag"), F.col("t.path").alias("path"))


def german_relations(triples: DataFrame, labels: DataFrame) -> DataFrame:
    """(subject, relation, object) of (subject, property, object): ends by their German name in (id, label), else as they are; without the prefixes
    of resources and ontology, underscores as blanks."""
    name = lambda c: F.replace(F.regexp_replace(c, r"^(dbpedia-de|dbr|dbo):", ""), F.lit("_"), F.lit(" "))
    out = triples
    for end in ("subject", "object"):
        out = out.join(labels.select(F.col("id").alias(end), F.col("label").alias(f"{end}_label")), end, "left").withColumn(f"{end}_name", name(F.coalesce(f"{end}_label", end)))
    return out.select(F.col("subject_name").alias("subject"), name(F.col("property")).alias("relation"), F.col("object_name").alias("object")).distinct()


def group_triples(triples: DataFrame) -> DataFrame:
    """(id, properties) of (subject, property, object)."""
    lists = triples.groupBy("subject", "property").agg(F.array_sort(F.collect_set("object")).alias("values"))
    return lists.groupBy(F.col("subject").alias("id")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("property", "values")))).alias("properties"))


def import_relations(relations: DataFrame, subjects: DataFrame) -> DataFrame:
    """(src, dst, relation): both ends of (subject, object, relation) found by name in (id, name)."""
    a = subjects.select(F.col("id").alias("src"), F.col("name").alias("subject"))
    b = subjects.select(F.col("id").alias("dst"), F.col("name").alias("object"))
    return relations.join(a, "subject").join(b, "object").select("src", "dst", "relation").distinct()


def relations_within(members: DataFrame, subjects: DataFrame) -> DataFrame:
    """What ``import_relations`` gives where, of the members (name, at, relation) with one relation, each is related to those that come after it: names
    are found once for each member, not for each pair, and as a pair is one of a first and a last place, each is given once."""
    m = members.join(subjects.select("id", "name"), "name")
    first = m.groupBy(F.col("id").alias("src"), "relation").agg(F.min("at").alias("first"))
    last = m.groupBy(F.col("id").alias("dst"), "relation").agg(F.max("at").alias("last"))
    return blocking.group_pairs(first, last, ["relation"]).where("first < last").select("src", "dst", "relation")


def add_relations(subjects: DataFrame, edges: DataFrame) -> DataFrame:
    """``relations`` map<dst, map<relation, value>> of (id, relations) with (src, dst, relation) added."""
    m = edges.groupBy("src", "dst").agg(F.map_from_entries(F.collect_set(F.struct("relation", F.lit("").alias("v")))).alias("m")).groupBy("src").agg(F.map_from_entries(F.collect_list(F.struct("dst", "m"))).alias("new"))
    j = subjects.join(m, subjects["id"] == m["src"], "left")
    merged = F.map_zip_with("relations", "new", lambda _, a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.map_concat(a, F.map_filter(b, lambda k, __: ~F.map_contains_key(a, k)))))
    return j.withColumn("relations", F.when(F.col("new").isNull(), F.col("relations")).otherwise(merged)).drop("src", "new")


def sentences_with_entities(articles: DataFrame) -> DataFrame:
    """(title, start, sentence, entities): of (title, text, links) the sentences with more than one link; entities are
    structs (alias, entity, offset in the sentence)."""
    cut = F.regexp_extract_all("text", F.lit(r"([^.!?\n]*[.!?\n]|[^.!?\n]+$)"), F.lit(1))
    ends = F.aggregate(cut, F.array(F.lit(0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + F.char_length(s))))
    s = articles.select("title", "links", cut.alias("cut"), ends.alias("ends")).select("title", "links", "ends", F.posexplode("cut").alias("i", "sentence"))
    s = s.withColumn("start", F.element_at("ends", F.col("i") + 1)).withColumn("end", F.col("start") + F.char_length("sentence"))
    inside = F.filter("links", lambda x: (x["offset"] >= F.col("start")) & (x["offset"] + F.char_length(x["alias"]) <= F.col("end")))
    ents = F.transform(inside, lambda x: F.struct(x["alias"].alias("alias"), x["page"].alias("entity"), (x["offset"] - F.col("start")).cast("int").alias("offset")))
    return s.select("title", "start", "sentence", ents.alias("entities")).where(F.size("entities") > 1)


#: Relations whose objects are places, of which sentences about companies name many.
PLACE_RELATIONS = ("country", "location", "locationCity", "locationCountry", "city", "state", "region", "headquarter")


def unwanted_pages(relations: DataFrame, names: DataFrame, kinds: tuple[str, ...] = PLACE_RELATIONS) -> DataFrame:
    """(page): objects of the kinds of relations (subject, relation, object), and the (page) that a list names."""
    return relations.where(F.col("relation").isin(*kinds)).select(F.col("object").alias("page")).unionByName(names.select("page")).distinct()


def filter_sentence_entities(sentences: DataFrame, companies: DataFrame, unwanted: DataFrame) -> DataFrame:
    """Entities that are companies (page) and not unwanted (page); sentences with more than one left."""
    e = sentences.select("title", "start", "sentence", F.posexplode("entities").alias("i", "e")).withColumn("page", F.col("e.entity"))
    e = e.join(companies.select("page").distinct(), "page", "left_semi").join(unwanted.select("page").distinct(), "page", "left_anti")
    g = e.groupBy("title", "start", "sentence").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "e"))), lambda x: x["e"]).alias("entities"))
    return g.where(F.size("entities") > 1)


def pattern_statistics(trees: DataFrame) -> DataFrame:
    """``pattern_frequency`` of each row's pattern; a null pattern counts as one pattern."""
    n = trees.groupBy("pattern").agg(F.count(F.lit(1)).alias("pattern_frequency"))
    return trees.join(n, F.expr("true") & trees["pattern"].eqNullSafe(n["pattern"])).drop(n["pattern"])
