"""Readers of dumps and writers of exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalise import clean_triple, escape_csv, literal_map, master_relations


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def xml_pages(spark: SparkSession, path: str, row_tag: str = "page") -> DataFrame:
    """(title, text) of every page element."""
    return spark.read.format("xml").option("rowTag", row_tag).schema("title string, revision struct<text string>, text string").load(path).select("title", F.coalesce("revision.text", "text").alias("text"))


def json_array_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dump with one array element a line: brackets and commas at the ends go, blank lines too."""
    clean = F.regexp_replace(F.regexp_replace(F.trim("value"), r"^\[", ""), r"[,\]]+$", "")
    return spark.read.text(path).select(clean.alias("json")).where("json <> ''").select(F.from_json("json", schema).alias("row")).select("row.*")


def triples(spark: SparkSession, path: str, prefixes: dict[str, str] | None = None) -> DataFrame:
    """(subject, property, object); comment lines are dropped."""
    t = spark.read.text(path).where("not startswith(value, '#') and trim(value) <> ''").select(clean_triple(F.col("value"), prefixes).alias("t"))
    return t.select(*[F.col("t")[i].alias(n) for i, n in enumerate(("subject", "property", "object"))])


def collection(spark: SparkSession, path: str, parse, keep=lambda value: F.lit(True)) -> DataFrame:
    """(value): what the function of a line's column makes of every line for which the other holds."""
    return spark.read.text(path).where(keep(F.col("value"))).select(parse(F.col("value")).alias("value"))


def key_values(spark: SparkSession, path: str, n: int = 2) -> DataFrame:
    """Tab-separated lines of exactly n fields, as ``fields``."""
    return spark.read.text(path).select(F.split("value", "\t").alias("fields")).where(F.size("fields") == n)


def word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(word, vector) of lines "word v1 v2 ..." with more than two fields."""
    f = F.split("value", " ")
    return spark.read.text(path).where(F.size(f) > 2).select(f[0].alias("word"), F.transform(F.slice(f, F.lit(2), F.size(f)), lambda x: x.cast("double")).alias("vector"))


def node_lines(nodes: DataFrame, id_col: str, name: str, *labels: str) -> DataFrame:
    """One CSV line for each node."""
    q = lambda c: F.concat(F.lit('"'), escape_csv(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit('"'))
    return nodes.select(F.concat_ws(",", q(id_col), q(name), *[q(x) for x in labels]).alias("value"))


COLOURS = {"business": "2471A3", "city": "A04000", "country": "27AE60", "organization": "A6ACAF", "sector": "D68910"}
#: The names that an export gives relations; others aren't exported.
RELATION_NAMES = {
    "distributes for": "distributingCompany;distributingLabel",
    "employed by": "employer",
    "follows": "follows;predecessor;replaces",
    "followed by": "followed by;replaced by;successor",
    "founded by": "foundedBy;founder;gen_founder",
    "founded in": "foundationPlace",
    "founded in location": "country of origin;location of formation",
    "contains location": "contains administrative territorial entity",
    "has central bank": "central bank",
    "has industry": "industry",
    "headquarters located in": "headquarters location",
    "invests in": "investor",
    "is key person": "keyPerson",
    "located in": "country;located in the administrative territorial entity;location;locationCity",
    "manufactured by": "manufacturer",
    "owned by": "business division;division;owned by;owner;owningCompany;parentCompany;parentOrganisation",
    "owns": "airline alliance;childOrganisation;owner of;parent organization;subsidiary",
    "produced by": "producer",
    "production company": "production company",
    "same as": "said to be the same as",
    "stock exchange": "stock exchange",
}


def subject_lines(subjects: DataFrame, keys: list[str]) -> DataFrame:
    """One CSV line for each of (id, name, aliases, category, properties): with the category's colour, then the properties of the vocabulary in its order;
    lists between semicolons."""
    q = lambda c: F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"'))
    join = lambda values: F.concat_ws(";", F.transform(values, escape_csv))
    colour = F.try_element_at(literal_map(COLOURS), F.coalesce("category", F.lit("")))
    props = [q(join(F.try_element_at("properties", F.lit(k)))) for k in sorted(keys)]
    return subjects.select(F.concat_ws(",", q(F.col("id")), q(escape_csv(F.col("name"))), q(join(F.col("aliases"))), q(F.col("category")), q(colour), *props).alias("value"))


def relation_lines(subjects: DataFrame) -> DataFrame:
    """id,destination,name for each different exported name of a relation of (id, relations); bookkeeping relations aren't exported."""
    names = literal_map({r: n for n, rs in RELATION_NAMES.items() for r in rs.split(";")})
    e = subjects.select("id", F.explode(master_relations(F.col("relations"))).alias("dst", "m")).select("id", "dst", F.explode(F.map_keys("m")).alias("r"))
    named = e.withColumn("name", F.try_element_at(names, F.col("r"))).where("name is not null").select("id", "dst", "name").distinct()
    return named.select(F.concat_ws(",", "id", "dst", "name").alias("value"))


def edge_lines(edges: DataFrame, relation: str) -> DataFrame:
    return edges.select(F.concat_ws(",", F.col("src").cast("string"), F.lit(relation), F.col("dst").cast("string")).alias("value"))


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)
