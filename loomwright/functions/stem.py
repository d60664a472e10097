"""A stemmer for German by Caumanns' published algorithm: letter groups are folded, endings stripped, groups unfolded."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_UMLAUTS = str.maketrans("äöü", "aou")
_GROUPS = (("sch", "$"), ("ch", "§"), ("ei", "%"), ("ie", "&"), ("ig", "#"), ("st", "!"))
_BACK = {short: group for group, short in _GROUPS}


def _fold(word: str) -> tuple[str, int]:
    """The folded word, and by how many letters it is shorter."""
    out: list[str] = []
    i = folded = 0
    while i < len(word):
        c = word[i].translate(_UMLAUTS)
        if out and c == out[-1]:
            out.append("*")
            i += 1
            continue
        if c == "ß":
            out += ["s", "s"] if i + 1 == len(word) else ["s", "*"]
            folded += 1
            i += 1
            continue
        if i + 1 < len(word):
            group = next((g for g in _GROUPS if word.startswith(g[0], i)), None)
            if group:
                out.append(group[1])
                folded += len(group[0]) - 1
                i += len(group[0])
                continue
        out.append(c)
        i += 1
    return "".join(out), folded


def _strip(w: str, folded: int) -> str:
    while len(w) > 3:
        if len(w) + folded > 5 and w.endswith("nd") or len(w) + folded > 4 and w.endswith(("em", "er")):
            w = w[:-2]
        elif w[-1] in "esnt":
            w = w[:-1]
        else:
            break
    return w


def stem(word: str) -> str:
    """Words with anything but letters stay as they are, in lower case."""
    w = word.lower()
    if not w.isalpha():
        return w
    w, folded = _fold(w)
    w = _strip(w, folded)
    if len(w) > 5 and w.endswith("erin*"):
        w = _strip(w[:-1], folded)
    if w.endswith("z"):
        w = w[:-1] + "x"
    out: list[str] = []
    for c in w:
        out.append(out[-1][-1] if c == "*" and out else _BACK.get(c, c))
    w = "".join(out)
    at = w.find("gege") if len(w) > 4 else -1
    return w if at < 0 else w[:at] + w[at + 2 :]


def stems(tokens: Column, step: int = 64) -> Column:
    """The stems of an array's tokens; each different token of a batch is stemmed once, and tokens of ``step`` rows at a time are Python's."""

    def run(col: pa.Array) -> pa.Array:
        known: dict[str, str] = {}
        parts = [pa.array([], pa.list_(pa.string()))]
        for at in range(0, len(col), step):
            out = []
            for ts in col.slice(at, step).to_pylist():
                if ts is not None:
                    for t in ts:
                        if t is not None and t not in known:
                            known[t] = stem(t)
                    ts = [None if t is None else known[t] for t in ts]
                out.append(ts)
            parts.append(pa.array(out, pa.list_(pa.string())))
        return pa.concat_arrays(parts)

    return F.arrow_udf(run, "array<string>")(tokens)
