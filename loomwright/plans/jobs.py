"""Jobs over a store of tables, pipelines of jobs that read what the jobs before them wrote, and a command line:

    python -m loomwright.plans.jobs STORE JOB_OR_PIPELINE [--flags]

A store is a folder of Parquet tables, or of sub-folders.  Every job replaces the table that it writes.  A query's name is a job too: it reads the
tables of the store and writes a table of its name.
"""

from __future__ import annotations

import argparse
import base64
import binascii
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise as norm
from ..operators import aliases, embeddings, entities, fusion, knowledge, learning, linking, relations, resolution, versions
from ..operators import text as tx
from ..sources import dumps, pages, wiki
from . import config as cfg
from . import configs
from .catalogue import QUERIES

_PROPS = "map<string,array<string>>"
_SUBJECT = ["id", "master", "datasource", "name", "aliases", "category", "properties", "relations"]


@dataclass
class Flags:
    """What the command line gives."""

    config: cfg.Config = field(default_factory=cfg.Config)
    import_config: cfg.Config = field(default_factory=cfg.Config)
    commit: dict = field(default_factory=dict)
    comment: str = ""
    tokenizer: tuple[str, ...] = ()
    reduced: bool = False
    restore_version: str | None = None
    diff_versions: tuple[str, str] | None = None
    sources: tuple[str, ...] = ("human", "kompass", "dbpedia", "wikidata")
    sectors: dict[str, list[str]] = field(default_factory=dict)
    root: str = "root"


@dataclass
class Store:
    spark: SparkSession
    folder: str
    flags: Flags = field(default_factory=Flags)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def has(self, name: str) -> bool:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame) -> None:
        """Through a table beside it, so that a job may read what it replaces."""
        df.write.mode("overwrite").parquet(self.path(f"{name}_new"))
        self.spark.read.parquet(self.path(f"{name}_new")).write.mode("overwrite").parquet(self.path(name))


@dataclass(frozen=True)
class Job:
    name: str
    reads: tuple[str, ...]
    writes: str
    run: Callable[..., DataFrame]


JOBS: dict[str, Job] = {}


def job(name: str, reads: str, writes: str):
    """Registers a function of the store and the tables that it reads."""

    def add(f):
        JOBS[name] = Job(name, tuple(reads.split()), writes, f)
        return f

    return add


# ---------------------------------------------------------------- imports


def _mapped(store: Store, table: DataFrame, source: str) -> DataFrame:
    return entities.to_subjects(table, source, store.flags.import_config.mapping, store.flags.sectors or store.flags.import_config.sectors)


@job("wikidata_import", "wikidata_lines wikidata_properties", "wikidata")
def wikidata_import(store, lines, names):
    """Entities of JSON lines: label in German, then English, aliases of all languages, claims by the names of their properties."""
    j = F.col("json")
    labels = lambda path: F.from_json(F.get_json_object(j, path), "map<string,struct<value:string>>")
    label = norm.label_with_fallback(F.transform_values(labels("$.labels"), lambda _, v: v["value"]), ["de", "en"])
    others = entities.all_aliases(F.transform_values(F.from_json(F.get_json_object(j, "$.aliases"), "map<string,array<struct<value:string>>>"), lambda _, v: F.transform(v, lambda x: x["value"])))
    claims = F.from_json(F.get_json_object(j, "$.claims"), "map<string,array<struct<mainsnak:struct<datavalue:string>>>>")
    data = F.map_filter(F.transform_values(claims, lambda _, v: F.filter(F.transform(v, lambda x: norm.claim(x["mainsnak"]["datavalue"], "$.value")), lambda x: x.isNotNull())), lambda _, v: F.size(v) > 0)
    e = lines.select(F.get_json_object(j, "$.id").alias("id"), label.alias("label"), F.lit(None).cast("string").alias("instancetype"), F.coalesce(others, F.array().cast("array<string>")).alias("aliases"), F.get_json_object(j, "$.sitelinks.dewiki.title").alias("wikiname"), F.coalesce(data, F.create_map().cast(_PROPS)).alias("data"))
    return entities.translate_keys(e, names)


@job("wikidata_tag", "wikidata", "wikidata")
def wikidata_tag(store, e):
    """The instance type: the root class of the first known class."""
    below = e.select(F.col("id").alias("child"), F.explode(F.coalesce(F.try_element_at("data", F.lit("subclass of")), F.array().cast("array<string>"))).alias("parent"))
    paths = aliases.subclass_paths(below, store.flags.root)
    known = e.select("id", F.coalesce(F.try_element_at("data", F.lit("instance of")), F.array().cast("array<string>")).alias("classes"))
    names = e.select(F.col("id").alias("tag"), F.col("label").alias("kind"))
    tags = knowledge.tag_entities(known, paths).join(names, "tag", "left").select("id", F.coalesce("kind", "tag").alias("kind"))
    return e.join(tags, "id", "left").withColumn("instancetype", F.coalesce("instancetype", "kind")).drop("kind")


@job("wikidata_resolve", "wikidata", "wikidata")
def wikidata_resolve(store, e):
    r = knowledge.resolve_entities(e.withColumnRenamed("data", "properties"), e.where("instancetype is null and label is not null").select("id", "label"))
    return r.withColumnRenamed("properties", "data")


@job("wikidata_subjects", "wikidata", "subject_wikidata")
def wikidata_subjects(store, e):
    return _mapped(store, e, "wikidata")


@job("wikidata_relations", "wikidata subject_wikidata", "subject_wikidata")
def wikidata_relations(store, e, subjects):
    """Values that are ids of subjects become relations."""
    ids = subjects.select("entity", F.col("id").alias("subject_id"))
    rel = knowledge.find_relations(e.withColumnRenamed("data", "properties"), subjects.select(F.col("entity").alias("id"), "name"))
    rel = rel.join(ids.withColumnsRenamed({"entity": "src", "subject_id": "a"}), "src").join(ids.withColumnsRenamed({"entity": "dst", "subject_id": "b"}), "dst")
    return knowledge.add_relations(subjects, rel.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("property").alias("relation")))


@job("dbpedia_import", "dbpedia_triples", "dbpedia")
def dbpedia_import(store, t):
    """Entities of triples; the type is the first ontology type."""
    g = knowledge.group_triples(t)
    types = F.filter(F.coalesce(F.try_element_at("properties", F.lit("rdf:type")), F.array().cast("array<string>")), lambda x: x.startswith("dbo:"))
    first = lambda k: F.try_element_at(F.try_element_at("properties", F.lit(k)), F.lit(1))
    return g.select("id", first("rdfs:label").alias("label"), F.replace(F.try_element_at(types, F.lit(1)), F.lit("dbo:"), F.lit("")).alias("instancetype"), F.array().cast("array<string>").alias("aliases"), F.col("properties").alias("data"))


@job("dbpedia_subjects", "dbpedia", "subject_dbpedia")
def dbpedia_subjects(store, e):
    return _mapped(store, e, "dbpedia")


@job("dbpedia_relations", "dbpedia_triples", "dbpedia_relations")
def dbpedia_relations(store, t):
    labels = t.where("property = 'owl:sameAs' and object like 'dbpedia-de:%'").select(F.col("subject").alias("id"), F.col("object").alias("label"))
    return knowledge.german_relations(t.where("property like 'dbo:%'"), labels)


@job("dbpedia_relation_import", "dbpedia_relations subject_dbpedia", "subject_dbpedia")
def dbpedia_relation_import(store, rel, subjects):
    return knowledge.add_relations(subjects, knowledge.import_relations(rel, subjects))


@job("kompass_parse", "kompass_pages", "kompass")
def kompass_parse(store, dump):
    return pages.directory_entities(dump)


@job("kompass_subjects", "kompass", "subject_kompass")
def kompass_subjects(store, e):
    return _mapped(store, e, "kompass")


# ---------------------------------------------------------------- resolution and curation


@job("deduplication", "subject staging", "duplicates")
def deduplication(store, subjects, staging):
    """Duplicates of staged subjects among the slaves, by the configuration file or the one that its setting ``resolution`` names."""
    c = store.flags.config
    which = configs.RESOLUTIONS[c.settings["resolution"]] if "resolution" in c.settings else configs.of(c) if c.similarity else configs.RESOLUTIONS["wikidata"]
    return configs.best_duplicates(which, subjects.where(entities.is_slave()), staging)


@job("merging", "duplicates subject staging", "subject")
def merging(store, found, subjects, staging):
    """Staged subjects attached to their duplicates' masters, or to masters of their own; these masters rebuilt."""
    at = resolution.attach_to_master(staging, found, subjects)
    new = staging.drop("master").join(at.select("id", "master", "score"), "id")
    own = F.create_map(F.col("master"), F.create_map(F.lit("master"), F.col("score").cast("string")))
    none = F.create_map().cast("map<string,map<string,string>>")
    rel = fusion.duplicate_relations(found).groupBy("src").agg(F.map_from_entries(F.collect_list(F.struct("dst", F.create_map("relation", "value")))).alias("dup"))
    new = new.join(rel, new["id"] == rel["src"], "left").withColumn("relations", F.map_concat(F.map_filter("relations", lambda k, _: ~k.eqNullSafe(F.col("master")) & ~F.map_contains_key(F.coalesce("dup", none), k)), own, F.coalesce("dup", none))).select(*_SUBJECT)
    empty = new.where("master like 'master-%'").select(F.col("master").alias("id"), "master", F.lit("master").alias("datasource"), "name", F.array().cast("array<string>").alias("aliases"), "category", F.create_map().cast(_PROPS).alias("properties"), none.alias("relations"))
    whole = subjects.select(*_SUBJECT).unionByName(new).unionByName(empty.join(subjects.select("id"), "id", "left_anti"))
    return fusion.update_masters(whole, store.flags.sources, new.select("master"))


@job("commit", "subject", "subject")
def commit(store, subjects):
    """The commit's created, updated and deleted subjects as rows of source human."""
    rows = [(str(id_), action, json.dumps(v)) for action, part in (("create", "created"), ("update", "updated"), ("delete", "deleted")) for id_, v in store.flags.commit.get(part, {}).items()]
    c = fusion.commit_rows(store.spark.createDataFrame(rows, "id string, action string, json string"))
    new = fusion.created(c)
    done = F.create_map(F.lit("deleted"), F.array(F.lit("true"))).cast(_PROPS)
    edits = c.where("action <> 'create'").select(F.col("id").alias("master"), "name", "aliases", "category", F.when(F.col("action") == "delete", done).otherwise(F.col("properties")).alias("properties"))
    old = subjects.where("datasource = 'human'").select("master", F.col("id").alias("old_id"), F.col("name").alias("n"), F.col("aliases").alias("a"), F.col("category").alias("c"), F.col("properties").alias("p"), F.col("relations").alias("r"))
    none = F.create_map().cast("map<string,map<string,string>>")
    m = edits.join(old, "master", "left").select(F.coalesce("old_id", F.concat(F.lit("human-"), "master")).alias("id"), "master", F.lit("human").alias("datasource"), F.coalesce("name", "n").alias("name"), F.when(F.size("aliases") > 0, F.col("aliases")).otherwise(F.coalesce("a", "aliases")).alias("aliases"), F.coalesce("category", "c").alias("category"), versions.merge_maps(F.coalesce("p", F.create_map().cast(_PROPS)), F.col("properties")).alias("properties"), F.coalesce("r", none).alias("relations"))
    s = subjects.select(*_SUBJECT)
    s = s.join(m.select("id", "datasource"), ["id", "datasource"], "left_anti").select(*_SUBJECT).unionByName(m)
    return s.unionByName(new.select(*_SUBJECT))


def _named(store: Store, subjects: DataFrame) -> DataFrame | None:
    ids = [str(x) for part in ("created", "updated", "deleted") for x in store.flags.commit.get(part, {})]
    if not ids:
        return None
    own = store.spark.createDataFrame([(x,) for i in ids for x in (i, f"master-{i}")], "master string")
    return own.join(subjects.select("master").distinct(), "master", "left_semi")


@job("master_update", "subject", "subject")
def master_update(store, subjects):
    return fusion.update_masters(subjects, store.flags.sources, _named(store, subjects))


@job("master_connecting", "subject", "subject")
def master_connecting(store, subjects):
    """Masters' relations to slaves lead to these slaves' masters."""
    masters = subjects.where(entities.is_master())
    flat = masters.select(F.col("id").alias("src"), F.explode(norm.master_relations(F.col("relations"))).alias("dst", "m")).select("src", "dst", F.explode("m").alias("relation", "value"))
    slaves = subjects.where(entities.is_slave()).select("id", "master", "datasource")
    led = fusion.connect(flat, slaves, store.flags.sources)
    stay = flat.join(slaves.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst", "relation", "value")
    both = led.unionByName(stay).groupBy("src", "dst", "relation").agg(F.min("value").alias("value"))
    inner = both.groupBy("src", "dst").agg(F.map_from_entries(F.collect_list(F.struct("relation", "value"))).alias("m")).groupBy("src").agg(F.map_from_entries(F.collect_list(F.struct("dst", "m"))).alias("new"))
    book = F.map_filter("relations", lambda _, m: F.exists(F.map_keys(m), lambda k: k.isin("slave", "master", "isDuplicate")))
    own = masters.join(inner, masters["id"] == inner["src"], "left").withColumn("relations", F.map_concat(F.map_filter(book, lambda k, _: ~F.map_contains_key(F.coalesce("new", F.create_map().cast("map<string,map<string,string>>")), k)), F.coalesce("new", F.create_map().cast("map<string,map<string,string>>"))))
    return own.select(*_SUBJECT).unionByName(subjects.where(~entities.is_master() | F.col("master").isNull()).select(*_SUBJECT))


@job("csv_export", "subject", "export")
def csv_export(store, subjects):
    """Lines (kind, value) of nodes and edges, of masters that aren't deleted."""
    m = subjects.where(entities.is_master() & ~entities.is_deleted(F.col("properties")))
    keys = [r["k"] for r in m.select(F.explode(F.map_keys("properties")).alias("k")).distinct().orderBy("k").collect()]  # the vocabulary of properties
    return dumps.subject_lines(m, keys).select(F.lit("node").alias("kind"), "value").unionByName(dumps.relation_lines(m).select(F.lit("edge").alias("kind"), "value"))


@job("version_restore", "subject_history", "subject_history")
def version_restore(store, subjects):
    return versions.restore(subjects, {"name": "name_history"}, F.lit(store.flags.restore_version))


@job("version_diff", "subject_history", "version_diff")
def version_diff(store, subjects):
    old, new = (versions.version_in(F.col("name_history"), F.lit(v))["value"] for v in store.flags.diff_versions or ("", ""))
    some = lambda v: F.filter(F.array(v), lambda x: x.isNotNull())
    return subjects.select("id", versions.diff(some(old), some(new)).alias("name")).where("name is not null")


# ---------------------------------------------------------------- text mining


@job("text_parser", "wikipedia", "articles")
def text_parser(store, dump):
    return wiki.parse_articles(dump).withColumn("tokens", tx.words(F.col("text")))


def _links(articles: DataFrame) -> DataFrame:
    """(doc_id, kind, alias, page, pos) of articles' text, template and category links; a disambiguation page's text links are of that kind."""
    x, nowhere = F.col("x"), F.lit(None).cast("int")

    def one(kind: Column, column: str, alias: Column, page: Column, pos: Column) -> DataFrame:
        rows = articles.select(F.col("title").alias("doc_id"), kind.alias("kind"), F.explode(column).alias("x"))
        return rows.select("doc_id", "kind", alias.alias("alias"), page.alias("page"), pos.alias("pos"))

    text = one(F.when(F.col("disambiguation"), "disambiguation").otherwise("text"), "links", x["alias"], x["page"], x["offset"])
    return text.unionByName(one(F.lit("template"), "template_links", x["alias"], x["page"], nowhere)).unionByName(one(F.lit("category"), "categories", x, x, nowhere))


@job("redirect_resolver", "articles", "links")
def redirect_resolver(store, a):
    """All links, by redirects to where these lead."""
    ends = aliases.resolve_redirects(a.where("redirect is not null").select(F.col("title").alias("src"), F.col("redirect").alias("dst")))
    return _links(a).join(ends.withColumnsRenamed({"src": "page", "dst": "end"}), "page", "left").withColumn("page", F.coalesce("end", "page")).select("doc_id", "kind", "alias", "page", "pos")


@job("link_cleaner", "links articles", "links")
def link_cleaner(store, links, a):
    """Links of text and templates to pages that exist and aren't meta pages; categories stay."""
    real = aliases.clean_links(links.where("kind <> 'category'"), a.select(F.col("title").alias("page"))).where(~wiki.is_meta(F.col("page")))
    cols = ["doc_id", "kind", "alias", "page", "pos"]
    return real.select(*cols).unionByName(links.where("kind = 'category'").select(*cols))


def _counts(links: DataFrame) -> DataFrame:
    return aliases.alias_scores(links.where("kind <> 'category' and alias <> '' and length(alias) <= 1000"))


@job("link_analysis", "links", "alias_pages")
def link_analysis(store, links):
    return _counts(links)


@job("company_link_filter", "links alias_pages wikidata", "links")
def company_link_filter(store, links, counts, e):
    return linking.reduce_links(links, linking.company_aliases(counts, linking.company_pages(e)))


@job("reduced_link_analysis", "links", "alias_pages_reduced")
def reduced_link_analysis(store, links):
    return _counts(links.where("reduced"))


@job("alias_trie_search", "articles alias_pages", "found_aliases")
def alias_trie_search(store, a, counts):
    return aliases.search(a.select(F.col("title").alias("doc_id"), "tokens"), counts.select("alias"), everything=True)


@job("link_extender", "articles links alias_pages_reduced", "extended_links")
def link_extender(store, a, links, counts):
    own = links.where("reduced and kind = 'text'").select("doc_id", "page")
    x = linking.extend_links(a.select(F.col("title").alias("doc_id"), "title", "tokens"), own, linking.relevant_aliases(counts.select("page", "alias", F.col("n").cast("int").alias("n"))))
    return x.withColumn("page", aliases.extended_link(F.col("pages"))).where("page is not null").select("doc_id", F.lit("extended").alias("kind"), "alias", "page", F.col("pos").cast("int").alias("pos"))


@job("second_link_analysis", "links extended_links", "alias_pages")
def second_link_analysis(store, links, extended):
    return _counts(links.select(*extended.columns).unionByName(extended))


@job("second_reduced_link_analysis", "links extended_links", "alias_pages_reduced")
def second_reduced_link_analysis(store, links, extended):
    return _counts(links.where("reduced").select(*extended.columns).unionByName(extended))


@job("alias_counter", "links found_aliases", "alias_occurrences")
def alias_counter(store, links, found):
    return aliases.alias_occurrences(links.where("kind = 'text'").select("doc_id", "alias"), found)


def _processed(store: Store, a: DataFrame) -> DataFrame:
    """(doc_id, tokens) as contexts take them."""
    process = tx.tokenizer(store.flags.tokenizer or ("words", "true", "false"))
    return a.select(F.col("title").alias("doc_id"), F.transform(process(F.col("text")), F.lower).alias("tokens"))


@job("term_frequency_counter", "articles", "term_frequencies")
def term_frequency_counter(store, a):
    return _processed(store, a).select("doc_id", F.explode("tokens").alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


@job("document_frequency_counter", "term_frequencies", "document_frequencies")
def document_frequency_counter(store, tf):
    return tx.document_frequency(tf)


@job("cosine_context_comparator", "articles links alias_pages alias_pages_reduced alias_occurrences term_frequencies document_frequencies", "features")
def cosine_context_comparator(store, a, links, counts, reduced, seen, tf, df):
    """Every linked mention with every page of its alias."""
    n = a.count()
    positions = aliases.search(a.select(F.col("title").alias("doc_id"), "tokens"), links.where("kind = 'text'").select("alias"))
    m = positions.join(links.where("kind = 'text'").select("doc_id", "alias", "page").distinct(), ["doc_id", "alias"])
    m = m.groupBy("doc_id", "pos", "alias").agg(F.min("page").alias("page"))  # of several links with one alias in an article the least page
    scores = reduced if store.flags.reduced else counts
    share = seen.select("alias", F.round(F.col("links") / F.col("total"), 6).alias("link_score"))
    s = scores.select("alias", "page", F.round("share", 6).alias("entity_score")).join(share, "alias")
    context = linking.contexts(_processed(store, a), m.withColumn("n", F.size(F.split("alias", " "))))
    return linking.candidate_features(m, tx.tf_idf(context, df, n), s, tx.tf_idf(tf, df, n).withColumnRenamed("doc_id", "page"))


@job("second_order_features", "features", "features_with_ranks")
def second_order_features(store, f):
    return linking.composite_features(f)


@job("classifier_training", "features_with_ranks", "nel_statistics")
def classifier_training(store, f):
    """The forest is saved beside the table; the table has the counts, scores and, where several candidates of a mention are taken, adjusted counts."""
    model = learning.random_forest(linking.prune_ranks(linking.finite(f)), linking.FEATURES, "label")
    learning.save_model(model, f"{store.folder}/nel_model")
    p = model.transform(linking.finite(f)).select("doc_id", "pos", (F.col("prediction") == 1).alias("prediction"), (F.col("label") == 1).alias("truth"))
    return resolution.precision_recall(resolution.adjusted_counts(p, ["doc_id", "pos"]).drop("tn"), undefined=float("nan"))


@job("text_nel", "features_with_ranks", "found_entities")
def text_nel(store, f):
    return linking.decide(f, learning.load_model(f"{store.folder}/nel_model"))


@job("sentence_parser", "articles links", "sentences")
def sentence_parser(store, a, links):
    return knowledge.sentences_with_entities(a.select("title", "text", "links"))


@job("cooccurrence_counter", "sentences", "cooccurrences")
def cooccurrence_counter(store, x):
    lists = x.select(F.array_distinct(F.transform("entities", lambda e: e["entity"])).alias("entities")).where("size(entities) > 1")
    return relations.cooccurrences(lists)


@job("sentence_embedding", "articles word_vectors", "embeddings")
def sentence_embedding(store, a, vectors):
    t = a.select(F.col("title").alias("id"), F.explode(embeddings.clean_tokens(F.col("tokens"))).alias("word"))
    n = t.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    e = embeddings.sentence_embeddings(t, vectors, embeddings.word_weights(n))
    return e.withColumn("embedding", embeddings.remove_component(F.col("embedding"), embeddings.first_component(e, "embedding")))


PIPELINES = {
    "wikidata": ["wikidata_import", "wikidata_tag", "wikidata_resolve", "wikidata_subjects", "wikidata_relations"],
    "dbpedia": ["dbpedia_import", "dbpedia_subjects", "dbpedia_relations", "dbpedia_relation_import"],
    "kompass": ["kompass_parse", "kompass_subjects"],
    "resolution": ["deduplication", "merging", "master_connecting", "csv_export"],
    "commit": ["commit", "master_update", "master_connecting", "csv_export"],
    "textmining": ["text_parser", "redirect_resolver", "link_cleaner", "link_analysis", "company_link_filter", "reduced_link_analysis", "alias_trie_search", "link_extender", "second_link_analysis", "second_reduced_link_analysis", "alias_counter", "term_frequency_counter", "document_frequency_counter", "cosine_context_comparator", "second_order_features", "classifier_training", "text_nel"],
    "relations": ["sentence_parser", "cooccurrence_counter"],
}


def run_job(store: Store, name: str) -> None:
    if name in JOBS:
        j = JOBS[name]
        missing = [t for t in j.reads if not store.has(t)]
        if missing:
            raise ValueError(f"{name} reads {', '.join(missing)}, which the store lacks")
        store.write(j.writes, j.run(store, *[store.read(t) for t in j.reads]))
    elif name in QUERIES:
        QUERIES[name](store.spark, store.folder).write.mode("overwrite").parquet(store.path(name))
    else:
        raise ValueError(f"no job {name!r}")


def run(store: Store, name: str) -> list[str]:
    """Runs a pipeline's jobs in order, or one job; returns their names."""
    jobs = PIPELINES.get(name, [name])
    for j in jobs:
        run_job(store, j)
    return jobs


def json_argument(text: str) -> dict:
    """JSON as it is or in base 64."""
    if not text.lstrip().startswith(("{", "[")):
        try:
            text = base64.b64decode(text, validate=True).decode()
        except (binascii.Error, UnicodeDecodeError) as e:
            raise ValueError("neither JSON nor JSON in base 64") from e
    return json.loads(text)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Runs a job or a pipeline over a store of tables.")
    p.add_argument("store")
    p.add_argument("job")
    p.add_argument("--config", "-c", help="an XML file of settings and measures")
    p.add_argument("--import-config", "-i", help="an XML file of attribute and sector mappings")
    p.add_argument("--commit-json", "-j", type=json_argument, default={}, help="plain or in base 64")
    p.add_argument("--comment", "-b", default="")
    p.add_argument("--tokenizer", "-t", nargs="+", default=[], help="a name, stop words or not, stemming or not")
    p.add_argument("--to-reduced", "-r", action="store_true")
    p.add_argument("--restore-version", "-v")
    p.add_argument("--diff-versions", "-d", nargs=2)
    p.add_argument("--sources", nargs="+", help="sources by priority, the first before the others")
    return p


def flags(args: argparse.Namespace) -> Flags:
    def read(path: str | None) -> cfg.Config:
        if path is None:
            return cfg.Config()
        with open(path, encoding="utf-8") as f:
            return cfg.read(f.read())

    if len(args.tokenizer) > 3:
        raise ValueError("a tokenizer takes at most three arguments")
    f = Flags(read(args.config), read(args.import_config), args.commit_json, args.comment, tuple(args.tokenizer), args.to_reduced, args.restore_version, tuple(args.diff_versions) if args.diff_versions else None)
    if args.sources:
        f.sources = tuple(args.sources)
    return f


if __name__ == "__main__":
    given = parser().parse_args()
    run(Store(SparkSession.builder.getOrCreate(), given.store, flags(given)), given.job)
