"""License scans by diagonal voting.

All rolling word k-gram hashes of every document are joined in Spark to the positions of the same k-grams in
the templates.  Each match votes for the diagonal document position - template position; votes are counted by
diagonal, diagonals within ``gap`` of each other are merged, and a span is verified by the share of the template's
words that its exact k-gram matches cover.

Null and empty texts and texts of fewer than k words match nothing.  Rows that are equal in doc_id and text are
reported once; other rows of one doc_id have their own spans; null doc_ids are reported as they are.  Texts are read whole, however long.  Spans that tie
are all reported.  An empty table has no spans.  Templates shorter than k words are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing as H
from .common import bounded, content_key, small

K, GAP, COVER = 3, 4, 0.75
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "rights-reserved": "All rights reserved.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def gram_lists(texts: pa.Array, k: int = K) -> pa.Array:
    """For each text, the hashes of its k-grams in order."""
    counts, values = [], []
    for s in H.slices(texts):
        doc, h = H.grams(H.tokenise(s), k)
        counts.append(H.per_doc(doc, len(s)))
        values.append(h.view(np.int64))
    offsets = np.r_[0, np.cumsum(np.concatenate(counts))] if counts else np.zeros(1, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))


def template_positions(spark: SparkSession, templates: dict[str, str], k: int = K) -> DataFrame:
    rows = []
    for name, text in sorted(templates.items()):
        grams = gram_lists(pa.array([text]), k).to_pylist()[0]
        if not grams:
            raise ValueError(f"template {name} has fewer than {k} words")
        rows += [(name, len(grams) + k - 1, i, h) for i, h in enumerate(grams)]
    return spark.createDataFrame(rows, "license string, words int, tpos int, gram long")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, k: int = K, gap: int = GAP, cover: float = COVER) -> DataFrame:
    """(doc_id, license, first_word, last_word, coverage) of every verified span."""

    @F.arrow_udf("array<long>")
    def grams(texts: pa.Array) -> pa.Array:
        return gram_lists(texts, k)

    t = small(template_positions(docs.sparkSession, TEMPLATES if templates is None else templates, k))
    rolling = bounded(docs).select("doc_id", content_key("text").alias("copy"), F.posexplode(grams("text")).alias("dpos", "gram"))
    votes = rolling.join(t, "gram").withColumn("diagonal", F.col("dpos") - F.col("tpos"))
    by_diagonal = votes.groupBy("doc_id", "copy", "license", "words", "diagonal").agg(F.collect_set("tpos").alias("tpos"), F.min("dpos").alias("lo"), F.max("dpos").alias("hi"))
    w = Window.partitionBy("doc_id", "copy", "license").orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(w) <= gap, 0).otherwise(1)
    runs = by_diagonal.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("doc_id", "copy", "license", "words", "run").agg(F.array_distinct(F.flatten(F.collect_list("tpos"))).alias("tpos"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    words = F.size(F.array_distinct(F.flatten(F.transform("tpos", lambda p: F.sequence(p, p + k - 1)))))
    out = spans.select("doc_id", "license", F.col("lo").alias("first_word"), (F.col("hi") + k - 1).alias("last_word"), F.round(words / F.col("words"), 6).alias("coverage"))
    return out.where(F.col("coverage") >= cover)


def sql(k: int = K, gap: int = GAP, cover: float = COVER) -> str:
    """The same in DuckDB's SQL, on grams as text."""
    words = r"regexp_extract_all(lower(text), '[^\x00-/:-@\x5b-\x60\x7b-\x7f]+')"
    given = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
    gram = "array_to_string(w[p + 1 : p + {}], ' ')".format(k)
    return f"""
with d as (select doc_id, md5(text) as copy, {words} as w from (select distinct doc_id, text from documents)), g as (select doc_id, copy, p as dpos, {gram} as gram from (select doc_id, copy, w, unnest(range(len(w) - {k - 1})) as p from d where len(w) >= {k})),
t as (select license, len(w) as words, p as tpos, {gram} as gram from (select license, w, unnest(range(len(w) - {k - 1})) as p from (select license, {words} as w from (values {given}) as x(license, text)))),
v as (select doc_id, copy, license, words, dpos - tpos as diagonal, dpos, tpos from g join t on g.gram = t.gram), r as (select *, diagonal - lag(diagonal) over (partition by doc_id, copy, license order by diagonal) as step from (select distinct doc_id, copy, license, diagonal from v)),
n as (select *, sum(case when step <= {gap} then 0 else 1 end) over (partition by doc_id, copy, license order by diagonal) as run from r), c as (select v.doc_id, v.copy, v.license, words, run, dpos, unnest(range(tpos, tpos + {k})) as covered from v join n on v.doc_id is not distinct from n.doc_id and v.copy = n.copy and v.license = n.license and v.diagonal = n.diagonal)
select doc_id, license, min(dpos)::int as first_word, (max(dpos) + {k - 1})::int as last_word, round(count(distinct covered) / words::double, 6) as coverage from c group by doc_id, copy, license, words, run having round(count(distinct covered) / words::double, 6) >= {cover}"""
