"""Queries of links, named-entity linking, sentences and embeddings, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import aliases, embeddings, knowledge, learning, linking, relations
from ..operators import text as tx
from ..session import durable, table
from ..sources import pages as page_sources
from ..sources import wiki
from .catalogue import _ALIASES, _JW, _LINKS, page_links, query

c = F.col


# ---------------------------------------------------------------- tokens


@query("tokenizers", "select conv_id, turn, len(string_split(text, ' ')) as blanks, (select string_agg(regexp_replace(x, '[().!?,;:''\"„“”`´]', '', 'g'), '|') from (select unnest(string_split_regex(text, '[ \\n]')) as x)) as clean, len(regexp_extract_all(text, '" + tx.WORD + "')) as words from conversations")
def tokenizers(s, d):
    t = c("text")
    return table(s, d, "conversations").select("conv_id", "turn", F.size(tx.whitespace_tokens(t)).cast("long").alias("blanks"), F.array_join(tx.clean_tokens(t), "|").alias("clean"), F.size(tx.words(t)).cast("long").alias("words"))


@query("processed_tokens", f"select doc_id, len(list_filter(regexp_extract_all(text, '{tx.WORD}'), lambda x: x not in ('the', 'and', 'der', 'die'))) as n from documents")
def processed_tokens(s, d):
    return table(s, d, "documents").select("doc_id", F.size(tx.tokenizer(["words", "true", "true"])(c("text"), ("the", "and", "der", "die"))).cast("long").alias("n"))


@query("symbol_filter", "select doc_id, len(list_filter(string_split(text, ' '), lambda x: regexp_matches(x, '[\\p{L}\\p{N}]') and lower(x) not in ('the', 'and'))) as n from documents")
def symbol_filter(s, d):
    return table(s, d, "documents").select("doc_id", F.size(tx.without_symbols(tx.whitespace_tokens(c("text")), ("the", "and"))).cast("long").alias("n"))


@query("alias_search_nested", _ALIASES + " select doc_id, alias, pos::int as pos from c")
def alias_search_nested(s, d):
    passages = table(s, d, "benchmark").select(F.array_join(tx.words(F.lower("text")), " ").alias("alias"))
    docs = table(s, d, "documents").select("doc_id", tx.words(F.lower("text")).alias("tokens"))
    return aliases.search(docs, passages, everything=True)


# ---------------------------------------------------------------- links of pages

_COMPANIES = "select distinct page from k where page_id % 3 = 0"


def _companies(k: DataFrame) -> DataFrame:
    return linking.company_pages(k.select(F.when(c("page_id") % 3 == 0, "company").alias("instancetype"), c("page").alias("wikiname")))


@query("company_aliases", _LINKS + f" select distinct alias from k where page in ({_COMPANIES})")
def company_aliases(s, d):
    k = page_links(s, d)
    return linking.company_aliases(k, _companies(k))


@query("reduced_links", _LINKS + f" select page_id, alias, page, alias in (select alias from k where page in ({_COMPANIES})) as reduced from k")
def reduced_links(s, d):
    k = page_links(s, d)
    return linking.reduce_links(k, linking.company_aliases(k, _companies(k))).select("page_id", "alias", "page", "reduced")


@query("all_links", _LINKS + f", r as (select *, alias in (select alias from k where page in ({_COMPANIES})) as reduced from k) select page_id as doc_id, case when length(alias) % 2 = 0 then 'text' else 'list' end as kind, alias, page, length(page) as pos from r where reduced and substr(alias, 1, 1) <> 't' union all select page_id, 'extended', alias, page, 0 from k where page_id % 2 = 0")
def all_links(s, d):
    k = page_links(s, d)
    links = linking.reduce_links(k, linking.company_aliases(k, _companies(k))).select(c("page_id").alias("doc_id"), F.when(F.length("alias") % 2 == 0, "text").otherwise("list").alias("kind"), "alias", "page", F.length("page").cast("long").alias("pos"), "reduced")
    extended = k.select(c("page_id").alias("doc_id"), "alias", F.when(c("page_id") % 2 == 0, c("page")).alias("page"), F.lit(0).cast("long").alias("pos"))
    return linking.all_links(linking.filter_links(links, F.substring("alias", 1, 1) != "t"), extended, reduced=True)


@query("valid_articles", _LINKS + ", t as (select page from k group by 1 having count(*) > 1), o as (select page_id, page, alias, row_number() over (partition by page_id order by page, alias) as pos from k) select page_id as doc_id, string_agg(alias || '>' || page, ';' order by pos) as links from o where page in (select page from t) group by 1")
def valid_articles(s, d):
    k = page_links(s, d)
    o = k.withColumn("pos", F.row_number().over(Window.partitionBy("page_id").orderBy("page", "alias"))).withColumnRenamed("page_id", "doc_id")
    titles = k.groupBy("page").count().where("count > 1").select("page")
    return linking.valid_articles(o, titles).select("doc_id", F.concat_ws(";", F.transform("links", lambda x: F.concat_ws(">", x["alias"], x["page"]))).alias("links"))


@query("relevant_aliases", "with n as (select p_brand as page, split_part(p_name, ' ', 1) as alias, count(*) as n from part group by 1, 2 union all select p_brand, case p_size % 3 when 0 then '#' when 1 then 'x' else '7up' end, count(*) from part group by 1, 2), t as (select *, sum(n) over (partition by page) as total from n) select page, alias, n from t where n / total::double > 0.1 and length(alias) <> 1 and alias <> '#'")
def relevant_aliases(s, d):
    p = table(s, d, "part")
    n = p.groupBy(c("p_brand").alias("page"), F.split("p_name", " ")[0].alias("alias")).agg(F.count(F.lit(1)).alias("n")).unionByName(p.groupBy(c("p_brand").alias("page"), F.when(c("p_size") % 3 == 0, "#").when(c("p_size") % 3 == 1, "x").otherwise("7up").alias("alias")).agg(F.count(F.lit(1)).alias("n")))
    return linking.relevant_aliases(n, 0.1)


#: Documents are articles about their language that link to their source; both are called by their rare words.
@query(
    "link_extension",
    f"""with t as (select doc_id, lang, source, regexp_extract_all(lower(text), '{tx.WORD}') as w from documents), x as (select doc_id, lang, source, unnest(w) as term, unnest(range(len(w))) as pos from t),
df as (select term from (select distinct doc_id, term from x) group by 1 having count(*) between 2 and 4), n as (select source as page, term as alias, count(*) as n from x where term in (select term from df) group by 1, 2 union all select lang, term, count(*) from x where term in (select term from df) group by 1, 2),
h as (select x.doc_id, x.pos, n.alias, n.page, n.n from x join n on n.alias = x.term and n.page in (x.source, x.lang)) select doc_id, pos::int as pos, alias, string_agg(page || '=' || n::varchar, ';' order by page) as pages from h group by 1, 2, 3""",
)
def link_extension(s, d):
    docs = table(s, d, "documents").select("doc_id", "lang", "source", tx.words(F.lower("text")).alias("tokens"))
    x = docs.select("doc_id", "lang", "source", F.explode("tokens").alias("alias"))
    rare = x.select("doc_id", "alias").distinct().groupBy("alias").count().where("count between 2 and 4").select("alias")
    x = durable(x.join(rare, "alias"))
    n = x.groupBy(c("source").alias("page"), "alias").agg(F.count(F.lit(1)).alias("n")).unionByName(x.groupBy(c("lang").alias("page"), "alias").agg(F.count(F.lit(1)).alias("n")))
    out = linking.extend_links(docs.select("doc_id", c("lang").alias("title"), "tokens"), docs.select("doc_id", c("source").alias("page")), n)
    return out.select("doc_id", "pos", "alias", F.concat_ws(";", F.transform(F.array_sort(F.map_entries("pages")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))).alias("pages"))


# ---------------------------------------------------------------- named-entity linking
#
# Mentions are the words that 5 to 8 documents have, pages the documents' sources: which source does a mention speak of?

_NEL = f"""with t as (select doc_id, source, regexp_extract_all(lower(text), '{tx.WORD}') as w from documents), x as (select doc_id, source, unnest(w) as term, unnest(range(len(w))) as pos from t),
df as (select term, count(distinct doc_id) as df from x group by 1), m as (select x.doc_id, pos, x.term as alias, source as page from x join df on x.term = df.term where df between 5 and 8),
idf as (select term, log10((select count(*) from documents) / (case when df >= 5 then df else 4 end)::double) as idf from df),
cv as (select m.doc_id, m.pos, x.term, count(*) * any_value(idf) as v from m join x on x.doc_id = m.doc_id and x.pos between m.pos - 20 and m.pos + 20 and x.pos <> m.pos join idf on x.term = idf.term group by 1, 2, 3), cn as (select doc_id, pos, sqrt(sum(v * v)) as n from cv group by 1, 2),
pv as (select source as page, x.term, count(*) * any_value(idf) as v from x join idf on x.term = idf.term group by 1, 2), pn as (select page, sqrt(sum(v * v)) as n from pv group by 1),
sc as (select alias, page, count(*) / sum(count(*)) over (partition by alias) as entity_score, sum(count(*)) over (partition by alias) / (sum(count(*)) over (partition by alias) + 1.0) as link_score from m group by 1, 2),
cd as (select m.doc_id, m.pos, m.alias, m.page as target, sc.page, link_score, entity_score from m join sc on m.alias = sc.alias), dt as (select cd.doc_id, cd.pos, cd.page, sum(cv.v * pv.v) as dot from cd join cv on cd.doc_id = cv.doc_id and cd.pos = cv.pos join pv on pv.page = cd.page and pv.term = cv.term group by 1, 2, 3),
f as (select cd.doc_id, cd.pos::int as pos, cd.alias, cd.page as entity, round(link_score, 6) as link_score, round(entity_score, 6) as entity_score, round(case when cn.n > 0 and pn.n > 0 then coalesce(dot, 0) / (cn.n * pn.n) else 0 end, 6) as cosine, (cd.target = cd.page)::int as label from cd left join dt on dt.doc_id = cd.doc_id and dt.pos = cd.pos and dt.page = cd.page left join cn on cn.doc_id = cd.doc_id and cn.pos = cd.pos left join pn on pn.page = cd.page)"""


def _candidates(s: SparkSession, d: str) -> DataFrame:
    docs = durable(table(s, d, "documents").select("doc_id", "source", tx.words(F.lower("text")).alias("tokens")))
    n = docs.count()
    tf = durable(docs.select("source", F.explode("tokens").alias("term")).groupBy("source", "term").agg(F.count(F.lit(1)).alias("tf")))
    df = docs.select(F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = durable(df)
    rare = df.where("df between 5 and 8").select(c("term").alias("alias"))
    found = docs.select("doc_id", c("source").alias("page"), F.posexplode("tokens").alias("pos", "alias"))
    m = durable(found.join(rare, "alias").select("doc_id", "pos", F.lit(1).alias("n"), "alias", "page"))
    often = df.where("df >= 5")
    vectors = tx.tf_idf(linking.contexts(docs, m), often, n)
    pages = tx.tf_idf(tf.withColumnRenamed("source", "page"), often, n)
    share = aliases.alias_scores(m)
    total = m.groupBy("alias").agg((F.count(F.lit(1)) / (F.count(F.lit(1)) + 1.0)).alias("link_score"))
    scores = share.join(total, "alias").select("alias", "page", F.round("link_score", 6).alias("link_score"), F.round("share", 6).alias("entity_score"))
    return linking.candidate_features(m, vectors, scores, pages)


@query("nel_candidates", _NEL + " select * from f")
def nel_candidates(s, d):
    return _candidates(s, d)


@query(
    "nel_features",
    _NEL
    + """, r as (select *, rank() over (partition by doc_id, pos order by entity_score desc) as entity_rank, rank() over (partition by doc_id, pos order by cosine desc) as cosine_rank, max(entity_score) over (partition by doc_id, pos) as et, max(cosine) over (partition by doc_id, pos) as ct,
(select max(o.entity_score) from f o where o.doc_id = f.doc_id and o.pos = f.pos and o.entity_score < f.entity_score) as en, (select max(o.cosine) from f o where o.doc_id = f.doc_id and o.pos = f.pos and o.cosine < f.cosine) as cn from f)
select doc_id, pos, alias, entity, entity_rank::int as entity_rank, cosine_rank::int as cosine_rank, case when entity_score = et then 'infinity'::double else round(et - entity_score, 6) end as entity_delta_top, case when cosine = ct then 'infinity'::double else round(ct - cosine, 6) end as cosine_delta_top, coalesce(round(entity_score - en, 6), 'infinity'::double) as entity_delta_successor, coalesce(round(cosine - cn, 6), 'infinity'::double) as cosine_delta_successor from r where entity_rank <= 9 and cosine_rank <= 9""",
)
def nel_features(s, d):
    f = linking.prune_ranks(linking.composite_features(durable(_candidates(s, d))))
    deltas = [F.round(f"{v}_{x}", 6).alias(f"{v}_{x}") for v in ("entity", "cosine") for x in ("delta_top", "delta_successor")]
    return f.select("doc_id", "pos", "alias", "entity", "entity_rank", "cosine_rank", *deltas)


@query("text_nel")
def text_nel(s, d):
    """(doc_id, pos, alias, entity): the pages that forests, each trained on other mentions, take for the mentions of all documents."""
    f = durable(linking.composite_features(durable(_candidates(s, d))))
    return linking.cross_decide(f).where("prediction = 1.0").select("doc_id", "pos", "alias", "entity")


def _monge_elkan(a: str, b: str) -> str:
    return f"list_avg(list_transform(string_split({a}, ' '), lambda x: list_max(list_transform(string_split({b}, ' '), lambda y: {_JW.format('x', 'y')}))))"


@query(
    "fuzzy_links",
    f"with m as (select distinct o_custkey as article, p_name || ' e' as name from orders join part on p_partkey = o_orderkey % (select max(p_partkey) from part)), n as (select distinct name from m), s as (select distinct p_name as id from part), k as (select n.name, s.id, round(0.7 * {_JW.format('s.id', 'n.name')} + 0.3 * greatest({_monge_elkan('s.id', 'n.name')}, {_monge_elkan('n.name', 's.id')}), 6) as score from n join s on lower(substr(s.id, 1, 5)) = lower(substr(n.name, 1, 5))), b as (select *, row_number() over (partition by name order by score desc, id) as r from k where score >= 0.7) select article, m.name, id as subject, score from m join b on m.name = b.name where r = 1",
)
def fuzzy_links(s, d):
    p = table(s, d, "part")
    top = p.agg(F.max("p_partkey")).first()[0]
    o = table(s, d, "orders").select(c("o_custkey").alias("article"), (c("o_orderkey") % top).alias("p_partkey"))
    mentions = o.join(p, "p_partkey").select("article", F.concat("p_name", F.lit(" e")).alias("name"))
    return linking.fuzzy_links(mentions, p.select(c("p_name").alias("id"), c("p_name").alias("name")).distinct())


# ---------------------------------------------------------------- articles and sentences


@query("wiki_articles", "select p_partkey, 'Die ' || p_brand || ' von ' || p_name || '.' as text, 2 as links, 4 as first, 10 + length(p_brand) - 1 as second, 'T' || p_size::varchar as template, p_type as category, case when p_partkey % 5 = 0 then p_name end as redirect from part where p_partkey % 5 > 0 union all select p_partkey, 'REDIRECT ' || p_name, 1, 9, null, null, null, p_name from part where p_partkey % 5 = 0")
def wiki_articles(s, d):
    p = table(s, d, "part")
    body = F.concat(F.lit("Die {{Info|[[T"), c("p_size").cast("string"), F.lit("|x]]}}[[P"), c("p_partkey").cast("string"), F.lit("|"), c("p_brand"), F.lit("]] von [["), c("p_name"), F.lit("]].[[Kategorie:"), c("p_type"), F.lit("]][[Datei:a.png]]"))
    a = wiki.parse_articles(p.select(c("p_partkey").cast("string").alias("title"), F.when(c("p_partkey") % 5 == 0, F.concat(F.lit("REDIRECT [["), "p_name", F.lit("]]"))).otherwise(body).alias("text")))
    at = lambda i: F.try_element_at("links", F.lit(i))["offset"]
    return a.select(c("title").cast("long").alias("p_partkey"), "text", F.size("links").alias("links"), at(1).alias("first"), at(2).alias("second"), F.try_element_at("template_links", F.lit(1))["page"].alias("template"), F.try_element_at("categories", F.lit(1)).alias("category"), "redirect")


@query("page_texts")
def page_texts(s, d):
    """The text of every page's article box, else its body."""
    dump = table(s, d, "pages").select(c("page_id").alias("id"), c("url").alias("title"), c("html").alias("content"))
    return page_sources.news_articles(dump)


@query("sentence_entities", "with p as (select p_partkey, p_brand, split_part(p_name, ' ', 2) as n from part), a as (select p_partkey, p_brand || ' buys ' || n || '.' as s1, ' Only ' || n || '.' as s2, p_brand, n from p) select p_partkey as title, 0 as start, s1 as sentence, '0,' || (length(p_brand) + 6)::varchar as offsets from a")
def sentence_entities(s, d):
    n = F.split("p_name", " ")[1]
    p = table(s, d, "part").select("p_partkey", "p_brand", n.alias("n"))
    t = F.concat("p_brand", F.lit(" buys "), "n", F.lit(". Only "), "n", F.lit("."))
    link = lambda alias, page, at: F.struct(F.col(alias).alias("alias"), page.alias("page"), at.cast("int").alias("offset"))
    links = F.array(link("p_brand", F.lit("A"), F.lit(0)), link("n", F.lit("B"), F.length("p_brand") + 6), link("n", F.lit("B"), F.length("p_brand") + F.length("n") + 13))
    x = knowledge.sentences_with_entities(p.select(c("p_partkey").alias("title"), t.alias("text"), links.alias("links")))
    pages = s.createDataFrame([("A",), ("B",), ("C",)], "page string")
    x = knowledge.filter_sentence_entities(x, pages, pages.where("page = 'C'"))
    return x.select("title", "start", "sentence", F.concat_ws(",", F.transform("entities", lambda e: e["offset"].cast("string"))).alias("offsets"))


@query("ordered_cooccurrence", "with f as (select l_orderkey as o, l_suppkey as k, min(l_linenumber * 1000000 + l_suppkey) as i from lineitem group by 1, 2), l as (select o, list(k order by i) as e from f group by 1 having count(*) > 1) select array_to_string(e, ',') as entities, count(*) as n from l group by 1")
def ordered_cooccurrence(s, d):
    x = table(s, d, "lineitem").withColumn("at", c("l_linenumber") * 1000000 + c("l_suppkey"))
    lists = relations.ordered_lists(x, "l_orderkey", "l_suppkey", "at")
    return relations.cooccurrences(lists).select(F.concat_ws(",", F.transform("entities", lambda e: e.cast("string"))).alias("entities"), "n")


# ---------------------------------------------------------------- classifiers and embeddings


@query("relation_classifier")
def relation_classifier(s, d):
    """Precision, recall and F of each of ten folds: is a document junk, by its words."""
    t = table(s, d, "documents").join(table(s, d, "labels"), "doc_id").select("doc_id", (1 - c("quality")).cast("double").alias("label"), tx.words(F.lower("text")).alias("tokens"))
    return learning.weighted_cross_validate(durable(t), "tokens", "label", ["doc_id"])


_WORDS = f"with t as (select doc_id, unnest(regexp_extract_all(lower(text), '{tx.WORD}')) as word from documents), n as (select word, count(*) as n from t group by 1)"


@query("word_weights", _WORDS + " select word, round(1e-3 / (1e-3 + n / (select sum(n) from n)::double), 9) as weight from n")
def word_weights(s, d):
    return embeddings.word_weights(_word_counts(s, d), 1e-3).select("word", F.round("weight", 9).alias("weight"))


def _word_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select(F.explode(tx.words(F.lower("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("sentence_embeddings", _WORDS + ", w as (select word, 1e-3 / (1e-3 + n / (select sum(n) from n)::double) as w from n), v as (select word, [length(word) / 10.0, ascii(word) / 100.0, 1.0] as v from (select distinct word from t) where length(word) % 3 > 0) select doc_id, round(sum(v[1] * w), 5) as x, round(sum(v[2] * w), 5) as y, round(sum(v[3] * w), 5) as z from t join v on t.word = v.word join w on t.word = w.word group by 1")
def sentence_embeddings(s, d):
    n = durable(_word_counts(s, d))
    v = n.where(F.length("word") % 3 > 0).select("word", F.array(F.length("word") / 10.0, F.ascii("word") / 100.0, F.lit(1.0)).alias("vector"))
    tokens = table(s, d, "documents").select(c("doc_id").alias("id"), F.explode(tx.words(F.lower("text"))).alias("word"))
    e = embeddings.sentence_embeddings(tokens, v, embeddings.word_weights(n, 1e-3))
    return e.select(c("id").alias("doc_id"), *[F.round(c("embedding")[i], 5).alias(x) for i, x in enumerate("xyz")])


@query("embedding_tokens", "select conv_id, turn, len(list_filter(string_split(replace(lower(text), '#', ''), ' '), lambda x: x <> '' and not regexp_matches(x, '[0-9]') and x not in ('the', 'of'))) as n from conversations")
def embedding_tokens(s, d):
    return table(s, d, "conversations").select("conv_id", "turn", F.size(embeddings.clean_tokens(tx.whitespace_tokens(c("text")), digits=False, stop=("the", "of"))).cast("long").alias("n"))
