"""The entity-resolution configurations that come with the engine: sides, confidence, measures.  Weights that aren't given are 0 and become equal if all
of a level are; both levels are normalised (see ``normalise_weights``)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..operators import blocking, resolution
from .config import Config

NAMES = [("JaroWinkler", 0.7), ("MongeElkan", 0.3)]


@dataclass(frozen=True)
class Resolution:
    """attributes: {attribute: (weight, [(measure, weight)])}."""

    subjects: str
    staging: str
    confidence: float
    attributes: dict[str, tuple[float, list[tuple[str, float]]]] = field(default_factory=dict)
    most: int = 1 << 20

    def similarity(self) -> dict[str, tuple[float, list[tuple[str, float, int]]]]:
        weights = sim.normalise_weights({a: w for a, (w, _) in self.attributes.items()}) if self.attributes else {}
        out = {}
        for a, (_, measures) in self.attributes.items():
            if a in weights:
                shares = sim.normalise_weights({i: w for i, (_, w) in enumerate(measures)})
                out[a] = (weights[a], [(measures[i][0], w, 1) for i, w in shares.items()])
        return out


#: Employees are compared exactly, as the name that was once written there meant no measure.
RESOLUTIONS = {
    "kompass_strict": Resolution("subject", "subject_kompass", 0.7, {"name": (0.6, [("JaroWinkler", 1.0)]), "gen_employees": (0.2, [("ExactMatchString", 1.0)]), "geo_city": (0.2, [("Jaccard", 1.0)])}),
    "dbpedia": Resolution("subject", "subject_dbpedia", 0.3, {"id_dbpedia": (0, [("ExactMatchString", 0)]), "id_wikidata": (0, [("ExactMatchString", 0)]), "name": (0, NAMES)}),
    "kompass": Resolution("subject", "subject_kompass", 0.3, {"name": (0, NAMES), "gen_urls": (0, [("UrlCompare", 0)])}),
    "wikidata": Resolution("subject", "subject_wikidata", 0.9, {"name": (0.8, NAMES), "gen_urls": (0.2, [("UrlCompare", 0)])}),
    "evaluation": Resolution("subject_dbpedia", "subject_wikidata", 0.7, {"name": (0.8, [("JaroWinkler", 0)]), "geo_country": (0.2, [("Jaccard", 0)])}, 500_000),
    "fuzzy_nel": Resolution("subject", "mentions", 0.7, {"name": (0, NAMES)}),
}


def of(config: Config, subjects: str = "subject", staging: str = "staging") -> Resolution:
    """A configuration file's resolution."""
    parts = {a: (w, [(m, x) for m, x, _ in ms]) for a, (w, ms) in config.similarity.items()}
    s = config.settings
    return Resolution(s.get("subjectTable", subjects), s.get("stagingTable", staging), float(s.get("minConfidence", s.get("confidence", "0.7"))), parts, int(s.get("maxBlockSize", 1 << 20)))


def _values(side: str, attribute: str) -> Column:
    if attribute == "name":
        return F.when(F.col(f"{side}_name").isNotNull(), F.array(F.col(f"{side}_name"))).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.try_element_at(F.col(f"{side}_properties"), F.lit(attribute)), F.array().cast("array<string>"))


def pair_score(config: Resolution) -> Column:
    """Of pairs with s_name, s_properties, t_name, t_properties: attributes that both have, by their strategy; weights aren't shared out anew."""
    score = F.lit(0.0)
    for attribute, (weight, measures) in config.similarity().items():
        a, b = _values("s", attribute), _values("t", attribute)
        value = F.lit(0.0)
        for name, w, n in measures:
            value = value + F.coalesce(_compare(attribute, a, b, name, n), F.lit(0.0)) * w
        score = score + F.when((F.size(a) > 0) & (F.size(b) > 0), value * weight).otherwise(0.0)
    return score


def _compare(attribute: str, a: Column, b: Column, name: str, n: int) -> Column:
    """Measures that run in Python can't be called for each pair of values in the plan, so they take a list's only or first value."""
    measure = sim.measure(name)
    if name in sim.IN_PYTHON:
        low = (lambda c: F.lower(c)) if sim.strategy(attribute) is sim.lower_average else (lambda c: c)
        return measure(low(F.try_element_at(a, F.lit(1))), low(F.try_element_at(b, F.lit(1))), n)
    return sim.strategy(attribute)(a, b, lambda x, y: measure(x, y, n))


def duplicates(config: Resolution, subjects: DataFrame, staging: DataFrame) -> DataFrame:
    """(subject, staging, score) over the confidence, of subjects (id, name, properties) in one block of first letters or of postal code."""
    postal = F.substring(F.try_element_at(F.try_element_at("properties", F.lit("geo_postal")), F.lit(1)), 1, 3)
    schemes = {"simple": blocking.simple(F.col("name")), "postal": blocking.listed(postal)}
    cols = ["id", "name", "properties"]
    p = blocking.block_pairs(subjects.select(*cols), staging.select(*cols), (schemes, schemes), config.most)
    scored = p.select(F.col("s_id").alias("subject"), F.col("t_id").alias("staging"), F.round(pair_score(config), 6).alias("score"))
    return scored.where(F.col("score") >= config.confidence)


def best_duplicates(config: Resolution, subjects: DataFrame, staging: DataFrame) -> DataFrame:
    return resolution.best_match(duplicates(config, subjects, staging))
