"""Normalisers and parsers of attribute values, as columns."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Forms by their names; names stand for themselves, patterns below come after them.
FORM_NAMES = {
    "AG": "Aktiengesellschaft;Gemeinnützige Aktiengesellschaft;Geschlossene Aktiengesellschaft;Kleine Aktiengesellschaft;Offene Aktiengesellschaft",
    "AdöR": "Anstalt des öffentlichen Rechts",
    "EG": "Eingetragene Genossenschaft",
    "GbR": "Gesellschaft bürgerlichen Rechts",
    "GmbH": "Gesellschaft mit beschränkter Haftung",
    "KG": "Kommanditgesellschaft",
    "KGaA": "Kommanditaktiengesellschaft;Kommanditgesellschaft auf Aktien;Kommanditgesellschaft auf Aktien (allgemein)",
    "SE": "Europäische Gesellschaft",
    "UG haftungsbeschränkt": "gemeinnützige UG haftungsbeschränkt;gesellschaft UG haftungsbeschränkt",
    "e.V.": "Verein;eingetragener Verein;gemeinnütziger Verein",
    "oHG": "OHG;Offene Handelsgesellschaft",
}
#: What a name ends with or has as a word, most specific first.
LEGAL_FORMS = [
    (r"(?i)gmbh\s*&\s*co\.?\s*kg\s*a\s*a", "GmbH & Co. KGaA"),
    (r"(?i)gmbh\s*&\s*co\.?\s*kg", "GmbH & Co. KG"),
    (r"(?i)\bag\s*&\s*co\.?\s*kg", "AG & Co. KG"),
    (r"(?i)\bggmbh\b", "gGmbH"),
    (r"(?i)\bgmbh\b|gesellschaft mit beschränkter haftung", "GmbH"),
    (r"(?i)\bug\b\s*\(?haftungsbeschränkt", "UG haftungsbeschränkt"),
    (r"\bKGaA\b|(?i)kommanditgesellschaft auf aktien", "KGaA"),
    (r"\bAG\b|(?i)aktiengesellschaft", "AG"),
    (r"(?i)\be\. ?v\.|eingetragener verein", "e.V."),
    (r"(?i)\be\. ?k\.|eingetragene[rn]? kauf(mann|frau)", "e.K."),
    (r"\be\.? ?G\b\.?|(?i)eingetragene genossenschaft", "EG"),
    (r"\bGbR\b|(?i)gesellschaft bürgerlichen rechts", "GbR"),
    (r"\b[oO]HG\b|(?i)offene handelsgesellschaft", "oHG"),
    (r"\bAdöR\b|(?i)anstalt des öffentlichen rechts", "AdöR"),
    (r"(?i)\binc\b\.?", "Inc."),
    (r"(?i)\bltd\b\.?", "Ltd."),
    (r"(?i)\bllc\b\.?", "LLC"),
    (r"(?i)\bs\. ?a\.(?! ?r)", "S.A."),
    (r"\bKG\b|(?i)kommanditgesellschaft", "KG"),
    (r"\bSE\b", "SE"),
]
COUNTRIES = {"Deutschland": "DE", "Germany": "DE", "Österreich": "AT", "Austria": "AT", "Schweiz": "CH", "Switzerland": "CH", "Frankreich": "FR", "France": "FR", "Spanien": "ES", "Spain": "ES", "Italien": "IT", "Italy": "IT", "Vereinigte Staaten": "US", "United States": "US", "Vereinigtes Königreich": "GB", "United Kingdom": "GB", "Japan": "JP", "China": "CN", "Niederlande": "NL", "Polen": "PL", "Belgien": "BE", "Dänemark": "DK", "Schweden": "SE"}


def country_names(language: str = "de") -> dict[str, str]:
    """ISO 3166 codes by the names that the JVM has for them in a language; without a JVM session the short list."""
    session = SparkSession.getActiveSession()
    jvm = getattr(session, "_jvm", None) if session else None
    if jvm is None:
        return dict(COUNTRIES)
    locale = jvm.java.util.Locale
    shown = locale.forLanguageTag(language)
    return COUNTRIES | {locale.forLanguageTag(f"und-{code}").getDisplayCountry(shown): code for code in locale.getISOCountries()}


_names: dict[str, str] = {}


def _country_names() -> dict[str, str]:
    if not _names:
        _names.update(country_names())
    return _names


def literal_map(table: dict, kind: str = "map<string,string>") -> Column:
    """A constant map, which costs no generated code however large it is."""
    return F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), kind)


def legal_form(name: Column) -> Column:
    """The first form that the name has, else null."""
    out = F.lit(None).cast("string")
    for pattern, form in reversed(LEGAL_FORMS):
        out = F.when(name.rlike(pattern), form).otherwise(out)
    return out


def legal_forms(values: Column) -> Column:
    """Each value by its name in FORM_NAMES, else by what it contains: AG, GmbH (with & Co. KG), e.V., e.K. (the last two anywhere, whatever their
    case, as callers of old results expect); others stay."""
    known = literal_map({n: form for form, names in FORM_NAMES.items() for n in names.split(";")})

    def one(v: Column) -> Column:
        bare = F.lower(F.regexp_replace(v, "[. ]", ""))
        limited = bare.contains("gmbh") | (bare.contains("mbh") & bare.rlike("gesellschaft|gemeinschaft"))
        found = F.when(bare.contains("aktiengesellschaft"), "AG").when(limited, F.when(bare.contains("cokg"), "GmbH & Co. KG").otherwise("GmbH")).when(bare.contains("ev"), "e.V.").when(bare.contains("ek"), "e.K.")
        return F.coalesce(F.try_element_at(known, v), found, v)

    return F.array_distinct(F.transform(F.transform(values, lambda v: F.regexp_replace(v, r" \.", ".")), one))


def country_code(name: Column) -> Column:
    """Two letters stay; known names are translated, others null."""
    known = literal_map(_country_names())
    return F.when(name.rlike("^[A-Z]{2}$"), name).otherwise(F.try_element_at(known, name))


def employees(text: Column) -> Column:
    return F.regexp_replace(F.nullif(F.regexp_extract(text, r"(\d+(?:[.,]\d{3})*)", 1), F.lit("")), "[.,]", "").cast("long")


def number_range(text: Column) -> Column:
    """struct(low, high) of "100 - 499 ..." or "> 500"."""
    nums = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d{3})*)")), lambda x: F.regexp_replace(x, r"\.", "").cast("long"))
    return F.struct(F.array_min(nums).alias("low"), F.when(F.size(nums) > 1, F.array_max(nums)).alias("high"))


def address(text: Column) -> Column:
    """struct(street, postal, city) of "Street 1 12345 City"."""
    p = r"^(.*?)[, ]*\b(\d{5})\b[, ]*(.*)$"
    return F.struct(*[F.nullif(F.trim(F.regexp_extract(text, p, i)), F.lit("")).alias(n) for i, n in ((1, "street"), (2, "postal"), (3, "city"))])


def valid_url(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST")).isNotNull() & url.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://")


def url_decode(url: Column) -> Column:
    """Lone percent signs and plus signs stay; underscores become blanks; leading slashes go."""
    safe = F.regexp_replace(F.regexp_replace(url, r"%(?!\p{XDigit}{2})", "%25"), r"\+", "%2B")
    return F.regexp_replace(F.translate(F.try_url_decode(safe), "_", " "), "^/+", "")


def claim(value: Column, path: str) -> Column:
    """A claim value as a string: text, entity id, time, coordinate "lat;long" or quantity "amount;unit"."""
    g = lambda p: F.get_json_object(value, f"{path}.{p}")
    return F.when(g("latitude").isNotNull(), F.concat_ws(";", g("latitude"), g("longitude"))).when(g("amount").isNotNull(), F.concat_ws(";", g("amount"), F.regexp_extract(F.coalesce(g("unit"), F.lit("")), r"([PQ]\d+|\d)$", 1))).otherwise(F.coalesce(g("id"), g("time"), g("text"), F.get_json_object(value, path)))


def label_with_fallback(labels: Column, languages: list[str]) -> Column:
    """From map<language, label>: the first of the languages, else the least other key's."""
    first = F.try_element_at(labels, F.array_min(F.map_keys(labels)))
    return F.coalesce(*[F.try_element_at(labels, F.lit(x)) for x in languages], first)


def map_attributes(props: Column, mapping: dict[str, list[str]]) -> Column:
    """map<target, values> from map<raw, values>; targets without values are left out."""
    get = lambda k: F.coalesce(F.try_element_at(props, F.lit(k)), F.array().cast("array<string>"))
    full = F.create_map(*[c for t, raws in mapping.items() for c in (F.lit(t), F.concat(*[get(r) for r in raws]))])
    return F.map_filter(full, lambda _, v: F.size(v) > 0)


def overlay(old: Column, new: Column) -> Column:
    """Of map<string, array<string>>: the new map's non-empty lists go before the old ones."""
    kept = F.map_filter(new, lambda _, v: F.size(v) > 0)
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(kept, k)), kept)


def json_list(value: Column, path: str) -> Column:
    """Strings of an array; null if there is none."""
    return F.from_json(F.get_json_object(value, path), "array<string>")


def json_map(value: Column, path: str = "$") -> Column:
    """Values of an object as text."""
    return F.from_json(F.get_json_object(value, path), "map<string,string>")


def json_double(value: Column, path: str) -> Column:
    return F.get_json_object(value, path).try_cast("double")


def json_boolean(value: Column, path: str) -> Column:
    return F.get_json_object(value, path).try_cast("boolean")


def json_date(value: Column, path: str, pattern: str) -> Column:
    return F.try_to_timestamp(F.get_json_object(value, path), F.lit(pattern)).cast("date")


def flatten_map(value: Column) -> Column:
    """map<string, array<string>> of an object: nested objects give "key.inner", arrays their values, others one value."""
    top = F.map_entries(json_map(value))

    def one(e: Column) -> Column:
        inner = F.map_entries(F.from_json(e["value"], "map<string,string>"))
        nested = F.transform(inner, lambda x: F.struct(F.concat_ws(".", e["key"], x["key"]).alias("key"), F.array(x["value"]).alias("value")))
        flat = F.array(F.struct(e["key"].alias("key"), F.when(e["value"].startswith("["), F.from_json(e["value"], "array<string>")).otherwise(F.array(e["value"])).alias("value")))
        return F.when(e["value"].startswith("{"), nested).otherwise(flat)

    return F.map_from_entries(F.flatten(F.transform(top, one)))


def is_number(s: Column) -> Column:
    return s.try_cast("double").isNotNull()


def entity_id(s: Column) -> Column:
    return s.rlike("^[PQ][0-9]+$")


def unit_id(s: Column) -> Column:
    """Whether a value ends with the id of its unit."""
    return s.rlike(";[PQ][0-9]+$")


def clean_triple(line: Column, prefixes: dict[str, str] | None = None, remove: str | None = None) -> Column:
    """Three cleaned parts of a triple's line, prefixes in place of addresses, in the order given; then what the pattern ``remove`` matches goes."""
    parts = F.filter(F.transform(F.split(line, "> "), lambda x: F.regexp_replace(F.trim(x), "^<|[<>\"]", "")), lambda x: ~x.isin("", "."))
    three = F.slice(F.concat(parts, F.array_repeat(F.lit(""), 3)), 1, 3)
    short = lambda x: reduce(lambda y, p: F.replace(y, F.lit(p[0]), F.lit(p[1])), (prefixes or {}).items(), x)
    three = F.transform(three, short)
    return three if remove is None else F.transform(three, lambda x: F.regexp_replace(x, remove, ""))


def escape_csv(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"\\", r"\\\\"), '"', '\\\\"')


def uuid_millis(uuid: Column) -> Column:
    """Milliseconds since 1970 of a time UUID."""
    hexes = F.concat(F.substring(uuid, 16, 3), F.substring(uuid, 10, 4), F.substring(uuid, 1, 8))
    return F.floor((F.conv(hexes, 16, 10).cast("decimal(20,0)") - F.lit(0x01B21DD213814000).cast("decimal(20,0)")) / 10000).cast("long")


def attribute(field_or_null: Column, props: Column, name: str) -> Column:
    """A field as a list, else the property, else an empty list."""
    return F.coalesce(F.when(field_or_null.isNotNull(), F.array(field_or_null)), F.try_element_at(props, F.lit(name)), F.array().cast("array<string>"))


def master_relations(relations: Column) -> Column:
    """Without bookkeeping relations and without destinations that then have none."""
    kept = F.transform_values(relations, lambda _, m: F.map_filter(m, lambda k, __: ~k.isin("master", "slave", "isDuplicate")))
    return F.map_filter(kept, lambda _, m: F.size(m) > 0)
