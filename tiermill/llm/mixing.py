"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Only DataFrame operations.  Documents are summed once into one row per source with a token mass for each language and
topic, so a hot source is combined before any shuffle.  Languages and topics are short parameter lists; sources are not
bounded and never leave the executors: their factor follows from the row itself.  Each round is one pass over the source
rows that returns one number per language and topic.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.plans.staging import stage

from .common import own_name

ROUNDS = 20  # raking rounds; each one fits the source, language and topic marginals in turn
STEPS = 12  # steps of the search for the sampling scale
REST = "other"  # stands for languages and topics without a target


@dataclass(frozen=True)
class Targets:
    """Target token shares.  A source's share grows with its own tokens to ``source_power`` (1: as found, 0: all equal).

    ``languages`` and ``topics`` give shares by name; REST is the share of all others (0 if absent).  Shares of names
    without documents are spread over the others.  ``keep`` is the share of all tokens the sample is to hold.
    """

    languages: Mapping[str, float]
    topics: Mapping[str, float]
    source_power: float = 0.5
    keep: float = 0.8
    seed: str = "mix"


def words(text: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: str, seed: str) -> Column:
    """A number in 0..1 that depends on the key only."""
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":" + seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32


def _names(names: Mapping[str, float]) -> list[str]:
    return [*[n for n in names if n != REST], REST]


def _place(column: str, names: list[str]) -> str:
    """SQL: the position of the column's value among the names, the last (REST) for null and unlisted ones."""
    quoted = [n.replace("\\", "\\\\").replace("'", "\\'") for n in names[:-1]]
    cases = "".join(f" WHEN '{n}' THEN {i}" for i, n in enumerate(quoted))
    return f"CASE {column}{cases} ELSE {len(names) - 1} END" if cases else "0"


def _doubles(values: list[float]) -> str:
    """SQL: a constant array.  A constant is handed to the generated code, not written into it, so all rounds share it."""
    return f"array({', '.join(f'{v!r}D' for v in values)})"


def _dot(value: str, array: str) -> str:
    """SQL: the sum over a row's masses x and the constant array's factors f of an expression in both."""
    return f"aggregate(zip_with(m, {array}, (x, f) -> {value}), 0D, (total, v) -> total + v)"


def mix_weights(documents: DataFrame, topic: Column, targets: Targets) -> DataFrame:
    """``documents`` with ``topic``, ``n_tokens``, ``weight``, ``probability`` and ``sampled``.

    Weights times token masses have the target marginals.  A document's probability is scale * weight, at most 1, with
    the scale that makes the expected tokens ``keep`` of all; it is sampled when a hash of its id lies below.  Null and
    unlisted languages or topics count as REST, a null source as the empty one.  Documents of a cell without tokens have
    weight 1 and probability 1.  Repeated rows count and are decided alike.  Existing columns of the five names are
    replaced; other columns stay.
    """
    added = ["topic", "n_tokens", "weight", "probability", "sampled"]
    langs, topics = _names(targets.languages), _names(targets.topics)
    cell_, source_, factor_, mass_, product_ = (own_name(documents, c) for c in ("_cell", "_source", "_a", "_m", "_x"))
    base = documents.withColumn("topic", topic)
    base = base.withColumns(
        {
            "n_tokens": words(),
            cell_: F.expr(f"{_place('lang', langs)} * {len(topics)} + {_place('topic', topics)}"),
            source_: F.coalesce("source", F.lit("")),
        }
    )
    cells = [(x, y) for x in langs for y in topics]
    sums = [F.expr(f"sum(CASE WHEN `{cell_}` = {i} THEN n_tokens ELSE 0 END)").cast("double") for i in range(len(cells))]
    masses = base.groupBy(source_).agg(F.array(*sums).alias("m"))
    masses = masses.withColumn("mass", F.expr("aggregate(m, 0D, (total, v) -> total + v)"))
    masses = stage(masses.withColumn("want", F.expr(f"if(mass > 0, pow(mass, {targets.source_power!r}D), 0D)")), "mix-sources")
    total, norm = masses.agg(F.sum("mass"), F.sum("want")).first()
    if not total:
        same = base.withColumns({"weight": F.lit(1.0), "probability": F.lit(1.0), "sampled": F.lit(True)})
        return same.select(*[c for c in documents.columns if c not in added], *added)

    def with_factor(factors: list[float]) -> DataFrame:
        """``a``, the source's factor: its target over its mass under the other factors."""
        own = masses.withColumn("own", F.expr(_dot("x * f", _doubles(factors))))
        return own.withColumn("a", F.expr("if(own > 0, want / own, 0D)") * F.element_at(F.expr(_doubles([total / norm])), 1))

    def shares(names: list[str], given: Mapping[str, float], present: dict) -> dict:
        kept = {n: given.get(n, 0.0) if present[n] else 0.0 for n in names}
        return {n: total * v / (sum(kept.values()) or 1.0) for n, v in kept.items()}

    b, c = dict.fromkeys(langs, 1.0), dict.fromkeys(topics, 1.0)
    want_b: dict = {}
    want_c: dict = {}
    factors = [1.0] * len(cells)
    for _ in range(ROUNDS):
        factors = [b[x] * c[y] for x, y in cells]
        row = with_factor(factors).agg(*(F.expr(f"sum(a * m[{i}])") for i in range(len(cells)))).first()
        got = dict(zip(cells, row, strict=True))
        if not want_b:
            want_b = shares(langs, targets.languages, {x: sum(got[x, y] for y in topics) for x in langs})
            want_c = shares(topics, targets.topics, {y: sum(got[x, y] for x in langs) for y in topics})
        for x in langs:
            have = sum(got[x, y] * b[x] * c[y] for y in topics)
            b = b | {x: b[x] * want_b[x] / have if have else 0.0}
        for y in topics:
            have = sum(got[x, y] * b[x] * c[y] for x in langs)
            c = c | {y: c[y] * want_c[y] / have if have else 0.0}
    weighted = with_factor(factors)
    final = _doubles([b[x] * c[y] for x, y in cells])

    scale, goal = targets.keep, targets.keep * total
    for _ in range(STEPS):
        full = F.expr("sum(" + _dot(f"if(a * f * {scale!r}D >= 1, x, 0D)", final) + ")")
        part = F.expr("sum(" + _dot(f"if(a * f * {scale!r}D < 1, x * a * f, 0D)", final) + ")")
        capped, free = weighted.agg(full, part).first()
        if not free:
            break
        scale = (goal - capped) / free

    joined = base.join(weighted.select(source_, F.col("a").alias(factor_), F.col("m").alias(mass_)), source_, "left")
    joined = joined.withColumn(product_, F.expr(f"if(`{mass_}`[`{cell_}`] > 0, `{factor_}` * {final}[`{cell_}`], NULL)"))
    chance = F.coalesce(F.least(F.col(product_) * scale, F.lit(1.0)), F.lit(1.0))
    kept = joined.withColumns({"weight": F.coalesce(product_, F.lit(1.0)), "probability": chance})
    kept = kept.withColumn("sampled", uniform("doc_id", targets.seed) < F.col("probability"))
    return kept.select(*[c for c in documents.columns if c not in added], *added)


def oracle(topic: str, targets: Targets) -> str:
    """The same as DuckDB SQL over ``documents``: weights raked cell by cell, rounded as the query rounds them."""
    quoted = lambda n: "'" + n.replace("'", "''") + "'"
    bucket = lambda col, names: f"CASE WHEN {col} IN ({', '.join(quoted(n) for n in names if n != REST)}) THEN {col} ELSE '{REST}' END"
    share = lambda col, names: "CASE " + " ".join(f"WHEN {col} = {quoted(n)} THEN {v}" for n, v in names.items()) + " ELSE 0 END"
    sql = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, lang, topic, n_tokens, coalesce(source, '') s, {bucket("lang", targets.languages)} l,
         {bucket("topic", targets.topics)} t
  FROM (SELECT *, {topic} AS topic, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
        FROM documents)),
cells AS MATERIALIZED (SELECT s, l, t, sum(n_tokens)::DOUBLE m FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
total AS (SELECT sum(m) m FROM cells),
ts AS (SELECT s, m ** {targets.source_power} / sum(m ** {targets.source_power}) OVER () share
       FROM (SELECT s, sum(m) m FROM cells GROUP BY s)),
tl AS (SELECT l, v / sum(v) OVER () share FROM (SELECT DISTINCT l, {share("l", targets.languages)} v FROM cells)),
tt AS (SELECT t, v / sum(v) OVER () share FROM (SELECT DISTINCT t, {share("t", targets.topics)} v FROM cells)),
w0 AS MATERIALIZED (
  SELECT cells.*, cells.m w, ts.share * total.m ws, tl.share * total.m wl, tt.share * total.m wt
  FROM cells JOIN ts USING (s) JOIN tl USING (l) JOIN tt USING (t), total)"""
    n = 0
    for _ in range(ROUNDS):
        for key in "slt":
            sql += f""",
w{n + 1} AS MATERIALIZED (SELECT * REPLACE (coalesce(w * w{key} / nullif(sum(w) OVER (PARTITION BY {key}), 0), 0) AS w) FROM w{n})"""
            n += 1
    sql += f""",
x AS MATERIALIZED (SELECT s, l, t, m, w / m x FROM w{n}),
k0 AS MATERIALIZED (SELECT {targets.keep}::DOUBLE k)"""
    for i in range(STEPS):
        sql += f""",
k{i + 1} AS MATERIALIZED (
  SELECT coalesce(({targets.keep} * any_value(total.m) - sum(CASE WHEN x * k >= 1 THEN x.m ELSE 0 END))
         / nullif(sum(CASE WHEN x * k < 1 THEN x.m * x ELSE 0 END), 0), any_value(k)) k FROM x, k{i}, total)"""
    return sql + f""",
r AS (
  SELECT doc_id, source, lang, topic, n_tokens, coalesce(x, 1) weight,
         CASE WHEN x IS NULL THEN 1 ELSE least(x * k, 1) END probability,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{targets.seed}'), 1, 8))::BIGINT / 4294967296.0 u
  FROM d LEFT JOIN x USING (s, l, t), k{STEPS})
SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) weight, round(probability, 6) probability,
       u < probability AS sampled
FROM r"""
