"""URL filters by link-graph propagation over hosts.

Host edges are the links of the pages with a host (with a scheme or after //; other relative ones stay on their host) and, for a host under another
host that has pages, an edge to that parent and back.  Trust is personalised PageRank from the trusted seeds along the edges, distrust the
same from the blocked seeds along the reversed edges; each is divided by its greatest value.  A host is blocked if it is a
blocked seed, or if it isn't trusted itself and its distrust is over ``threshold`` and over its trust.

Rounds go on until no score changes at DIGITS + 3 digits, at most ROUNDS of them; what is still to flow then is at most DAMPING ** ROUNDS (0.0015)
of all rank.  What dead ends hold isn't redistributed.

Pages without a readable host (null, empty, no scheme) are kept with null scores.  Repeated rows stay repeated, and their links count as often.
Pages are searched whole, however long.  Hosts that tie in trust and distrust are kept.  Without seeds of a kind, its scores are 0.  An empty table
has no hosts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, small

DAMPING, ROUNDS, THRESHOLD, DIGITS = 0.85, 40, 0.2, 9
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
LINK = r"""(?i)href\s*=\s*["']?((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^"'\s>]+)"""
TRUSTED = (".example.org",)
BLOCKED = ("blog.",)


def host(url) -> F.Column:
    h = F.regexp_extract(F.lower(url), HOST, 1)
    return F.when(h != "", h)


def page_hosts(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, links): what the rest needs of each page, read once; links are the hosts it links to, null for unreadable ones."""
    found = F.when(F.col("html").contains("//"), F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    links = F.transform(found, lambda x: host(F.regexp_replace(x, "^//", "http://")))
    return durable(pages.select("page_id", "url", host(F.col("url")).alias("host"), links.alias("links")))


def host_edges(own: DataFrame) -> DataFrame:
    """(src, dst, weight), no loops, of the rows of ``page_hosts``."""
    own = own.where("host is not null").select(F.col("host").alias("src"), "links")
    links = own.select("src", F.explode("links").alias("dst")).where("dst is not null and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    hosts = own.select("src").distinct()
    parents = hosts.select("src", F.regexp_extract("src", r"^[^.]+\.(.+)$", 1).alias("dst")).join(hosts.select(F.col("src").alias("dst")), "dst", "left_semi").select("src", "dst", F.lit(1).cast("long").alias("weight"))
    back = parents.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return links.unionByName(parents).unionByName(back).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, score): personalised PageRank from ``seeds`` (host), without redistribution of what dead ends hold."""
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    share = durable(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share")))
    n = seeds.count()
    start = seeds.select("host", F.lit(1.0 / max(1, n)).alias("score"))
    rank = start
    for i in range(rounds):
        flow = share.join(rank, share["src"] == rank["host"]).groupBy("dst").agg(F.sum(F.col("share") * F.col("score")).alias("flow")).select(F.col("dst").alias("host"), (F.lit(damping) * F.col("flow")).alias("score"))
        new = flow.unionByName(start.select("host", (F.lit(1 - damping) * F.col("score")).alias("score"))).groupBy("host").agg(F.round(F.sum("score"), DIGITS + 3).alias("score"))
        if i % 4 == 3:
            new = durable(new)
            before = rank.select(F.col("host").alias("h"), F.col("score").alias("s"))
            if new.join(before, F.col("host") == F.col("h"), "full").where("not (score <=> s)").isEmpty():
                return new
        rank = new
    return rank


def host_scores(own: DataFrame, trusted: DataFrame, blocked: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust, blocked) for every host of the rows of ``page_hosts``.  ``trusted`` and ``blocked`` have a column host."""
    hosts = own.select("host").where("host is not null").distinct()
    edges = durable(host_edges(own))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    score = {}
    for name, e, seeds in (("trust", edges, trusted), ("distrust", back, blocked)):
        rank = propagate(e, durable(seeds.select("host").where("host is not null").distinct()), rounds, damping)
        top = rank.agg(F.max("score").alias("top"))
        score[name] = rank.crossJoin(F.broadcast(top)).select("host", (F.col("score") / F.col("top")).alias(name))  # one row
    seed = blocked.select("host").distinct().withColumn("seed", F.lit(True))
    good = trusted.select("host").distinct().withColumn("good", F.lit(True))
    out = hosts.join(score["trust"], "host", "left").join(score["distrust"], "host", "left").join(seed, "host", "left").join(good, "host", "left")
    out = out.select("host", F.round(F.coalesce("trust", F.lit(0.0)), DIGITS).alias("trust"), F.round(F.coalesce("distrust", F.lit(0.0)), DIGITS).alias("distrust"), "seed", "good")
    rule = F.col("seed").isNotNull() | (F.col("good").isNull() & (F.col("distrust") > threshold) & (F.col("distrust") > F.col("trust")))
    return out.select("host", "trust", "distrust", rule.alias("blocked"))


def pattern_seeds(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seeds by the host lists TRUSTED (suffixes) and BLOCKED (first labels)."""
    hosts = own.select("host").where("host is not null").distinct()
    bad = F.lit(False)
    for x in BLOCKED:
        bad = bad | F.col("host").startswith(x)
    good = F.lit(False)
    for x in TRUSTED:
        good = good | F.col("host").endswith(x)
    return hosts.where(good & ~bad), hosts.where(bad)


def filter_pages(pages: DataFrame, trusted: DataFrame | None = None, blocked: DataFrame | None = None, **params) -> DataFrame:
    """(page_id, url, host, trust, distrust, keep) of every page.  The seeds are tables with a column host; if one isn't given there are none of its
    kind, if neither is, the patterns TRUSTED and BLOCKED choose them."""
    own = page_hosts(pages)
    none = own.select("host").where("false")
    if trusted is None and blocked is None:
        trusted, blocked = pattern_seeds(own)
    scores = durable(host_scores(own, none if trusted is None else trusted, none if blocked is None else blocked, **params))
    return own.drop("links").join(small(scores), "host", "left").select("page_id", "url", "host", "trust", "distrust", F.coalesce(~F.col("blocked"), F.lit(True)).alias("keep"))


def sql() -> str:
    """The same in DuckDB's SQL, rounds written out."""
    bad = " or ".join(f"starts_with(host, '{x}')" for x in BLOCKED)
    good = " or ".join(f"ends_with(host, '{x}')" for x in TRUSTED)
    link = LINK.replace("'", "''")
    parts = [
        f"own as (select page_id, url, html, nullif(regexp_extract(lower(url), '{HOST}', 1), '') as host from pages)",
        "hosts as (select distinct host from own where host is not null)",
        f"links as (select host as src, nullif(regexp_extract(lower(regexp_replace(link, '^//', 'http://')), '{HOST}', 1), '') as dst from (select host, unnest(regexp_extract_all(html, '{link}', 1)) as link from own where host is not null))",
        "parents as (select host as src, regexp_extract(host, '^[^.]+[.](.+)$', 1) as dst from hosts where regexp_extract(host, '^[^.]+[.](.+)$', 1) in (select host from hosts))",
        "edges as (select src, dst, sum(w) as w from (select src, dst, 1 as w from links where dst is not null and src <> dst union all select src, dst, 1 from parents union all select dst, src, 1 from parents) group by 1, 2)",
        f"good as (select host from hosts where ({good}) and not ({bad}))",
        f"bad as (select host from hosts where {bad})",
    ]
    for name, seeds, a, b in (("t", "good", "src", "dst"), ("d", "bad", "dst", "src")):
        parts.append(f"{name}s as materialized (select e.{a} as a, e.{b} as b, e.w / o.o as share from edges e join (select {a} as a, sum(w) as o from edges group by 1) o on e.{a} = o.a)")
        parts.append(f"{name}0 as (select host, 1.0::double / (select greatest(1, count(*)) from {seeds}) as score from {seeds})")
        for i in range(ROUNDS):
            parts.append(f"{name}{i + 1} as materialized (select host, round(sum(score), {DIGITS + 3}) as score from (select s.b as host, {DAMPING} * sum(s.share * r.score) as score from {name}s s join {name}{i} r on s.a = r.host group by 1 union all select host, (1 - {DAMPING}) * score from {name}0) group by 1)")
    parts.append(
        f"scores as (select h.host, round(coalesce(t.score / (select max(score) from t{ROUNDS}), 0), {DIGITS}) as trust, round(coalesce(d.score / (select max(score) from d{ROUNDS}), 0), {DIGITS}) as distrust, b.host is not null as seed, g.host is not null as good from hosts h left join t{ROUNDS} t on h.host = t.host left join d{ROUNDS} d on h.host = d.host left join bad b on h.host = b.host left join good g on h.host = g.host)"
    )
    return f"with {', '.join(parts)} select page_id, url, own.host, trust, distrust, coalesce(not (seed or (not good and distrust > {THRESHOLD} and distrust > trust)), true) as keep from own left join scores on own.host = scores.host"
