"""From source entities to subjects: attribute normalisers of each source, categories, sectors, names of properties, and what a subject tells.

An entity has id, label, instancetype, aliases (array) and data (map<string, array<string>>); a subject has id, master, datasource, name,
aliases, category, properties (map<string, array<string>>) and relations (map<string, map<string, string>>).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalise as norm

SOURCES = ("wikidata", "dbpedia", "kompass")
_BY_CATEGORY = {
    "wikidata": {
        "business": "association;business enterprise;chamber of commerce;collection agency;company;copyright collective;enterprise;environmental organization;exchange;financial institutions;health maintenance organization;institute;lobbying organization;media company;medical organization;non-governmental organization;operation",
        "city": "local government in Germany;municipality of Germany",
        "country": "state",
        "organization": "statutory corporation",
        "sector": "economic branch",
    },
    "dbpedia": {
        "business": "Broadcaster;Company;EmployersOrganisation;GovernmentAgency;InternationalOrganisation;PublicTransitSystem;SambaSchool;SportsClub;SportsLeague;SportsTeam;TradeUnion",
        "organization": "EducationalInstitution;GeopoliticalOrganisation;Legislature;MilitaryUnit;Non-ProfitOrganisation;Parliament;PoliticalParty;ReligiousOrganisation;TermOfOffice",
    },
}
_STRINGS = "array<string>"


def _map(pairs: dict) -> Column:
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))])


def category(kind: Column, source: str) -> Column:
    """The category of an instance type; a Kompass entity's type is its category."""
    if source not in _BY_CATEGORY:
        return kind
    return F.try_element_at(norm.literal_map({t: c for c, types in _BY_CATEGORY[source].items() for t in types.split(";")}), kind)


def expand(values: Column, table: dict[str, list[str]]) -> Column:
    """Every value replaced by its values in the table; others stay."""
    if not table:
        return values
    known = norm.literal_map(table, "map<string,array<string>>")
    return F.flatten(F.transform(values, lambda v: F.coalesce(F.try_element_at(known, v), F.array(v))))


def all_aliases(aliases: Column) -> Column:
    """Of map<language, array<string>>: the aliases of all languages, in the order of these."""
    return F.flatten(F.transform(F.array_sort(F.map_keys(aliases)), lambda k: F.element_at(aliases, k)))


def translate_keys(entities: DataFrame, names: DataFrame, column: str = "data") -> DataFrame:
    """Keys of the map column replaced by their name in (id, name); unknown ones stay.  Of several keys with one name the values are joined in the
    order of the keys."""
    e = entities.select("id", F.explode(column).alias("key", "values")).join(names.select(F.col("id").alias("key"), "name"), "key", "left")
    lists = e.groupBy("id", F.coalesce("name", "key").alias("key")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col("key").alias("k"), "values"))), lambda x: x["values"])).alias("values"))
    maps = lists.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "values")))).alias(column))
    rest = [c for c in entities.columns if c != column]
    return entities.select(*rest).join(maps, "id", "left").withColumn(column, F.coalesce(column, F.create_map().cast(f"map<string,{_STRINGS}>")))


# ---------------------------------------------------------------- normalisers: lists of raw values to lists of clean ones

_NAME = r"[A-Za-zÄäÖöÜüß_-]"


def _cases(*cases: tuple[str, Callable[[Column], Column] | None], otherwise: bool = False, unique: bool = True) -> Callable[[Column], Column]:
    """Each value by the first pattern that it matches whole: its first group, or what the case's function makes of the value; values that match none
    stay or go."""

    def run(values: Column) -> Column:
        def one(v: Column) -> Column:
            out = F.array(v) if otherwise else F.array().cast(_STRINGS)
            for pattern, make in reversed(cases):
                out = F.when(v.rlike(f"^(?:{pattern})$"), make(v) if make else F.array(F.regexp_extract(v, f"^(?:{pattern})$", 1))).otherwise(out)
            return out

        found = F.flatten(F.transform(values, one))
        return F.array_distinct(found) if unique else found

    return run


def _blanks(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda values: F.array_distinct(F.transform(f(values), lambda v: F.regexp_replace(v, "[_-]", " ")))


def _codes(pattern: str) -> tuple[str, Callable[[Column], Column]]:
    def code(v: Column) -> Column:
        c = norm.country_code(F.regexp_replace(F.regexp_extract(v, f"^(?:{pattern})$", 1), "_", " "))
        return F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast(_STRINGS))

    return pattern, code


def _plain(v: Column) -> Column:
    return F.array(v)


def _urls(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda values: F.filter(f(values), norm.valid_url)


def _pick(pattern: str, *groups: tuple[int, str]) -> tuple[str, Callable[[Column], Column]]:
    """Groups of the pattern without blanks and dots, each with zeros to append."""
    full = f"^(?:{pattern})$"
    return pattern, lambda v: F.array(*[F.concat(F.regexp_replace(F.regexp_extract(v, full, g), "[ .]", "") if g else F.lit("0"), F.lit(zeros)) for g, zeros in groups])


_GERMAN, _WIKI = r"(.+)@de \.", r"dbpedia-de:(.+)"
_ADDRESS = r"(.+) (\d{5}) (.+) Deutschland"
_KEEP = lambda values: values


def _kompass_forms(values: Column) -> Column:
    def one(v: Column) -> Column:
        kg = F.when(v.contains("& Co. KG"), "GmbH & Co. KG").otherwise("GmbH")
        short = F.regexp_extract(v, r"^.*?\((.{0,4})\)$", 1)
        return F.when(v.rlike(r"^.*?\(.{0,4}\)$"), short).when(v.rlike(r"(?i)gesellschaft.*?(haftungsbeschränkt|mit beschränkter haftung)"), kg).when(v.contains("GbR"), "GbR").when(v.rlike("(?i)ohg"), "OHG").otherwise(v)

    return F.array_distinct(F.transform(norm.legal_forms(values), one))


NORMALISERS: dict[str, dict[str, Callable[[Column], Column]]] = {
    "wikidata": {
        "gen_sectors": _cases((rf"({_NAME}*)", None)),
        "gen_employees": _cases((r"\+(\d+);1", None)),
        "gen_urls": lambda v: F.array_distinct(_urls(_KEEP)(v)),
        "gen_legal_form": norm.legal_forms,
        "geo_coords": _cases((r"[-+]?[0-9]+\.?[0-9]*;[-+]?[0-9]+\.?[0-9]*", _plain)),
        "geo_country": _cases(_codes(r"([A-Za-zÄäÖöÜüß_ -]*)")),
        "geo_city": _blanks(_cases((r"([A-Za-zÄäÖöÜüß_ -]*)", None))),
        "": _blanks(_KEEP),
    },
    "dbpedia": {
        "gen_sectors": _cases((rf"dbpedia-de:({_NAME}+)", None), (rf"({_NAME}+)@de \.", None)),
        "gen_employees": _blanks(_cases((r"([-+]?[0-9]+\.?[0-9]*)\^\^xsd:(?:integer|nonNegativeInteger)", None), (r"über (\d+)@de \.", None))),
        "gen_urls": _urls(_cases((_GERMAN, None), otherwise=True, unique=False)),
        "gen_legal_form": lambda v: norm.legal_forms(_blanks(_cases((_WIKI, None), (_GERMAN, None), otherwise=True))(v)),
        "geo_coords": _cases((r"(\d+\.\d*)\^\^xsd:.+;(\d+\.\d*)\^\^xsd:.+", lambda v: F.array(F.concat_ws(";", F.regexp_extract(v, r"^(\d+\.\d*)\^", 1), F.regexp_extract(v, r";(\d+\.\d*)\^", 1))))),
        "geo_country": _cases(_codes(rf"dbpedia-de:({_NAME}{{2,}})"), _codes(r"([A-Za-zÄäÖöÜüß-]{2,})@de \.")),
        "geo_city": _blanks(_cases((_WIKI, None), (_GERMAN, None), otherwise=True)),
        "": _blanks(_cases((r"(.+)\^\^xsd:.+", None), (_GERMAN, None), (_WIKI, None), otherwise=True)),
    },
    "kompass": {
        "gen_legal_form": _kompass_forms,
        "gen_capital": _cases(_pick(r"([0-9.]+) EUR", (1, ""))),
        "gen_turnover": _cases(_pick(r"([0-9.]+) EUR", (1, "")), _pick(r"([0-9]+) Million(?:en)? EUR", (1, "000000")), _pick(r"< ([0-9 ]+) EUR", (0, ""), (1, "")), _pick(r"([0-9]+) - ([0-9]+) Millionen EUR", (1, "000000"), (2, "000000")), _pick(r"([0-9 ]+) - ([0-9]+) Million(?:en)? EUR", (1, ""), (2, "000000"))),
        "gen_employees": _cases(_pick(r"Von ([0-9]+) bis ([0-9]+) Beschäftigte", (1, ""), (2, "")), _pick(r"(?:Mehr als )?([0-9]+) Beschäftigte", (1, ""))),
        "geo_street": _cases((_ADDRESS, lambda v: F.array(F.regexp_replace(F.regexp_extract(v, f"^{_ADDRESS}$", 1), r"^(.*?)str\.", "$1straße")))),
        "geo_postal": _cases((_ADDRESS, lambda v: F.array(F.regexp_extract(v, f"^{_ADDRESS}$", 2)))),
        "geo_city": _cases((_ADDRESS, lambda v: F.array(F.regexp_extract(v, f"^{_ADDRESS}$", 3))), (".*Deutschland", lambda v: F.array().cast(_STRINGS)), otherwise=True),
        "geo_country": _cases((_ADDRESS, lambda v: F.array(F.lit("DE")))),
        "": _KEEP,
    },
}


def normalise(source: str, attribute: str, values: Column) -> Column:
    """A source's values of an attribute, cleaned; attributes without a rule of their own have the source's general one."""
    if source not in NORMALISERS:
        raise ValueError(f"no source {source!r}; there are {', '.join(NORMALISERS)}")
    rules = NORMALISERS[source]
    given = F.array_distinct(F.filter(values, lambda v: v != "")) if source == "kompass" else values
    return rules.get(attribute, rules[""])(given)


def to_subjects(entities: DataFrame, source: str, mapping: dict[str, list[str]], sectors: dict[str, list[str]] | None = None) -> DataFrame:
    """Subjects of the entities that have a type (Kompass: of all): name, aliases, category, the raw properties, the legal form of the name, and the
    mapped attributes normalised; coordinates given apart are joined pairwise.  A subject's id follows from source and entity."""
    e = entities if source == "kompass" else entities.where("instancetype is not null")
    raw = norm.map_attributes(F.col("data"), mapping)
    clean = {}
    for a in mapping:
        values = normalise(source, a, F.coalesce(F.try_element_at(F.col("raw_"), F.lit(a)), F.array().cast(_STRINGS)))
        clean[a] = expand(values, sectors or {}) if a == "gen_sectors" else values
    form = norm.legal_form(F.col("name"))
    forms = _map({"gen_legal_form": norm.legal_forms(F.when(form.isNotNull(), F.array(form)).otherwise(F.array().cast(_STRINGS)))})
    out = e.withColumn("raw_", raw).withColumn("name", F.regexp_replace("label", r"@de \.$", "") if source == "dbpedia" else F.col("label"))
    props = norm.overlay(norm.overlay(F.col("data"), forms), _map(clean))
    if {"geo_coords_lat", "geo_coords_long"} <= set(mapping):
        lat, long = clean["geo_coords_lat"], clean["geo_coords_long"]
        pairs = F.filter(F.zip_with(lat, long, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(";", a, b))), lambda x: x.isNotNull())
        props = norm.overlay(props, _map({"geo_coords": pairs}))
    aliases = F.coalesce(F.try_element_at("data", F.lit("foaf:name")), F.array().cast(_STRINGS)) if source == "dbpedia" else F.coalesce("aliases", F.array().cast(_STRINGS)) if "aliases" in entities.columns else F.array().cast(_STRINGS)
    key = F.sha2(F.concat_ws("/", F.lit(source), F.col("id").cast("string")), 256)
    return out.select(key.alias("id"), F.lit(None).cast("string").alias("master"), F.lit(source).alias("datasource"), "name", F.array_distinct(aliases).alias("aliases"), category(F.col("instancetype"), source).alias("category"), props.alias("properties"), F.create_map().cast("map<string,map<string,string>>").alias("relations"), F.col("id").alias("entity"))


# ---------------------------------------------------------------- what a subject tells


def is_master(id_: str = "id", master: str = "master") -> Column:
    return F.col(id_) == F.col(master)


def is_slave(id_: str = "id", master: str = "master") -> Column:
    """A row without a master is neither."""
    return F.col(id_) != F.col(master)


def is_deleted(properties: Column) -> Column:
    return F.coalesce(F.array_contains(F.try_element_at(properties, F.lit("deleted")), "true"), F.lit(False))


def known_properties(properties: Column, names: list[str]) -> Column:
    """The properties of a closed vocabulary."""
    return F.map_filter(properties, lambda k, _: k.isin(*names))


def slaves(relations: Column) -> Column:
    """Destinations of slave relations, sorted."""
    return F.array_sort(F.map_keys(F.map_filter(relations, lambda _, m: F.map_contains_key(m, "slave"))))


def master_score(relations: Column, master: Column) -> Column:
    return F.try_element_at(F.try_element_at(relations, master), F.lit("master")).try_cast("double")


def destination(relations: Column, relation: str) -> Column:
    """The least destination that has the relation, else null."""
    return F.array_min(F.map_keys(F.map_filter(relations, lambda _, m: F.map_contains_key(m, relation))))


def tsv_line(*columns: Column) -> Column:
    """Tab-separated; tabs, line ends and backslashes in values are escaped, nulls empty."""
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\\", r"\\\\"), "\t", r"\\t"), "\n", r"\\n")
    return F.concat_ws("\t", *map(clean, columns))
