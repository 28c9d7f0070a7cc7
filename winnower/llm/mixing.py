"""Mixing sources to target weights by iterative proportional fitting, in built-ins only.

Documents are summed into cells of (source, language, topic). A sweep scales
the tokens that are wanted of each cell to the target shares of each margin in
turn, of a budget that is a stated rate of all tokens. A cell that is wanted more
than whole is taken whole, and the sweeps go on with the others, until no margin
is off its targets by more than a tolerance; ``mix_report`` tells the gaps that are
left. A document's probability is the wanted part of its cell; a hash of the
document decides. So a rare cell decides about itself only, and the size of the
sample follows from the rate.

Cells are far fewer than documents and are summed in the map tasks first, so a
source with a third of all rows costs its task no more than any other.

Defined cases: a null source, language or topic is the class ""; a null or
wordless text has no tokens and probability zero, as has a class without target;
repeated rows share one decision; a null doc_id is decided by its text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.storage import written

MARGINS = ("source", "lang", "topic")
_BROADCAST_CELLS = 50_000
_SWEEPS_PER_CHECK = 2
_HASH_DIGITS = 12


@dataclass(frozen=True)
class MixTargets:
    """Target of each margin: shares by class, or the exponent that tempers present shares.

    ``rate`` is the part of all tokens to sample; it cannot be reached where the
    targets ask for more than there is of most classes.
    """

    source: float | Mapping[str, float] = 0.85
    lang: float | Mapping[str, float] = 0.85
    topic: float | Mapping[str, float] = 0.85
    rate: float = 0.5
    tolerance: float = 0.001
    most_sweeps: int = 12
    seed: int = 42


def text_topic(text: Column) -> Column:
    """Form of a text as its topic: table, symbols, long or plain."""
    bars = F.regexp_count(text, F.lit("[|]"))
    symbols = F.regexp_count(text, F.lit("[#*$%&]"))
    length = F.length(text)
    return (
        F.when(50 * bars >= length, "table")
        .when(20 * symbols >= length, "symbols")
        .when(length >= 8000, "long")
        .otherwise("plain")
    )


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\x09-\\x0D]+")), F.lit(0)).cast("long")


def _with_cell(docs: DataFrame, text: str, doc_id: str, topic: Column | None) -> DataFrame:
    """Input columns as c_0, c_1, ... beside the class, the tokens and the identity of a row."""
    kind = text_topic(F.col(text)) if topic is None else topic
    classes = {"source": F.col("source"), "lang": F.col("lang"), "topic": kind}
    own_text = F.md5(F.coalesce(F.col(text), F.lit("")))
    return docs.select(
        *[F.col(name).alias(f"c_{i}") for i, name in enumerate(docs.columns)],
        *[F.coalesce(c.cast("string"), F.lit("")).alias(f"_{n}") for n, c in classes.items()],
        token_count(F.col(text)).alias("_tokens"),
        F.coalesce(F.col(doc_id).cast("string"), own_text).alias("_identity"),
    )


def _targets(cells: DataFrame, margin: str, target: float | Mapping[str, float]) -> DataFrame:
    """(_margin, _share) with shares that sum to one."""
    if isinstance(target, Mapping):
        total = sum(target.values())
        rows = [(name, value / total) for name, value in target.items()]
        return cells.sparkSession.createDataFrame(rows, f"_{margin} string, _share double")
    sums = cells.groupBy(f"_{margin}").agg(F.sum("_tokens").cast("double").alias("_sum"))
    tempered = sums.withColumn("_raw", F.when(F.col("_sum") > 0, F.pow("_sum", F.lit(target))))
    total = tempered.agg(F.sum("_raw").alias("_total"))
    return tempered.join(F.broadcast(total)).select(
        f"_{margin}", (F.col("_raw") / F.col("_total")).alias("_share")
    )


def _swept(cells: DataFrame, shares: dict[str, DataFrame], budget: float) -> DataFrame:
    """One sweep: each margin in turn is scaled to its targets, no cell beyond its tokens."""
    for margin in MARGINS:
        sums = cells.groupBy(f"_{margin}").agg(F.sum("_weight").alias("_now"))
        wanted = F.coalesce("_share", F.lit(0.0)) * F.lit(budget)
        factor = sums.join(shares[margin], f"_{margin}", "left").select(
            f"_{margin}", F.when(F.col("_now") > 0, wanted / F.col("_now")).otherwise(0.0).alias("_factor")
        )
        scaled = F.least(F.col("_tokens").cast("double"), F.col("_weight") * F.col("_factor"))
        cells = cells.join(factor, f"_{margin}").withColumn("_weight", scaled).drop("_factor")
    return cells


def _margins(cells: DataFrame, shares: dict[str, DataFrame]) -> DataFrame:
    """(margin, class, target, reached) of every class that has tokens or a target."""
    total = cells.agg(F.sum("_weight")).first()[0] or 0.0
    found = None
    for margin, share in shares.items():
        sums = cells.groupBy(f"_{margin}").agg(F.sum("_weight").alias("_now"))
        reached = F.coalesce("_now", F.lit(0.0)) / F.lit(total) if total else F.lit(0.0)
        rows = sums.join(share, f"_{margin}", "full").select(
            F.lit(margin).alias("margin"),
            F.col(f"_{margin}").alias("class"),
            F.coalesce("_share", F.lit(0.0)).alias("target"),
            reached.alias("reached"),
        )
        found = rows if found is None else found.union(rows)
    return found


@dataclass(frozen=True)
class Mix:
    """Fitted cells (_source, _lang, _topic, _tokens, _weight), their margins and the sweeps taken.

    ``_weight`` counts the tokens wanted of a cell, at most all that it has.
    """

    cells: DataFrame
    margins: DataFrame
    sweeps: int


def fit_cells(cells: DataFrame, targets: MixTargets) -> Mix:
    """Sweeps until the largest gap of a margin is within the tolerance, or as often as allowed.

    Every few sweeps are written, which bounds the plan. Classes of a margin
    without a target get weight zero.
    """
    spark = cells.sparkSession
    shares = {
        margin: written(spark, _targets(cells, margin, getattr(targets, margin)), f"{margin}-share")
        for margin in MARGINS
    }
    budget = targets.rate * float(cells.agg(F.sum("_tokens")).first()[0] or 0)
    fitted = cells.withColumn("_weight", F.col("_tokens").cast("double"))
    for sweep in range(1, targets.most_sweeps + 1):
        fitted = _swept(fitted, shares, budget)
        if sweep % _SWEEPS_PER_CHECK and sweep < targets.most_sweeps:
            continue
        fitted = written(spark, fitted, "mix-sweep")
        margins = _margins(fitted, shares)
        gap = margins.agg(F.max(F.abs(F.col("target") - F.col("reached")))).first()[0]
        if (gap or 0.0) <= targets.tolerance:
            break
    return Mix(fitted, margins, sweep)


def mix_report(
    docs: DataFrame,
    targets: MixTargets = MixTargets(),
    text: str = "text",
    doc_id: str = "doc_id",
    topic: Column | None = None,
) -> DataFrame:
    """(margin, class, target, reached, gap) of the tokens that the sample is expected to hold."""
    found = _fitted(_with_cell(docs, text, doc_id, topic), targets).margins
    return found.withColumn("gap", F.col("reached") - F.col("target"))


def _fitted(marked: DataFrame, targets: MixTargets) -> Mix:
    sums = marked.groupBy(*(f"_{name}" for name in MARGINS)).agg(F.sum("_tokens").alias("_tokens"))
    return fit_cells(written(marked.sparkSession, sums, "mix-cells"), targets)


def _decided(
    docs: DataFrame, targets: MixTargets, text: str, doc_id: str, topic: Column | None
) -> DataFrame:
    """Rows of _with_cell with _p and _sampled.

    Fitted cells are broadcast up to a checked number of rows; beyond it the
    join sorts both sides, and adaptive execution splits a common cell.
    """
    spark = docs.sparkSession
    marked = _with_cell(docs, text, doc_id, topic)
    keys = [f"_{name}" for name in MARGINS]
    # Rounded, so that the order of sums over cells cannot tip a decision.
    part = F.when(F.col("_tokens") > 0, F.round(F.col("_weight") / F.col("_tokens"), 9)).otherwise(0.0)
    rates = _fitted(marked, targets).cells.select(*keys, part.alias("_p"))
    rates = written(spark, rates, "mix-rates")
    if rates.count() <= _BROADCAST_CELLS:
        rates = F.broadcast(rates)
    key = F.concat(F.lit(f"{targets.seed}:"), F.col("_identity"))
    digits = F.substring(F.md5(key), 1, _HASH_DIGITS)
    uniform = F.conv(digits, 16, 10).cast("double") / float(16**_HASH_DIGITS)
    joined = marked.join(rates, keys).withColumn(
        "_p", F.when(F.col("_tokens") > 0, F.col("_p")).otherwise(0.0)
    )
    return joined.withColumn("_sampled", uniform < F.col("_p"))


def with_probability(
    docs: DataFrame,
    targets: MixTargets = MixTargets(),
    text: str = "text",
    doc_id: str = "doc_id",
    topic: Column | None = None,
) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, p, sampled), one row for each row."""
    found = _decided(docs, targets, text, doc_id, topic)
    return found.select(
        F.col(f"c_{docs.columns.index(doc_id)}").alias("doc_id"),
        *[F.col(f"_{name}").alias(name) for name in MARGINS],
        F.col("_tokens").alias("n_tokens"),
        F.col("_p").alias("p"),
        F.col("_sampled").alias("sampled"),
    )


def sample_mix(
    docs: DataFrame,
    targets: MixTargets = MixTargets(),
    text: str = "text",
    doc_id: str = "doc_id",
    topic: Column | None = None,
) -> DataFrame:
    """The sampled rows in the columns of the input."""
    chosen = _decided(docs, targets, text, doc_id, topic).filter("_sampled")
    return chosen.select(*[F.col(f"c_{i}").alias(name) for i, name in enumerate(docs.columns)])


def mix_sql(
    most_sweeps: int = 12,
    exponent: float = 0.85,
    rate: float = 0.5,
    tolerance: float = 0.001,
    seed: int = 42,
) -> str:
    """The same sample as DuckDB SQL: one expression for each margin of each sweep.

    Every few sweeps have their largest gap; the first that is small enough counts.
    """
    steps, weights, checks = [], "w0", []
    for step in range(1, 3 * most_sweeps + 1):
        margin = MARGINS[(step - 1) % 3]
        steps.append(
            f"w{step} as materialized (select source, lang, topic, tokens, least(tokens, weight * coalesce("
            f"share * budget / nullif(sum(weight) over (partition by {margin}), 0), 0)) as weight"
            f" from {weights} join t_{margin} using ({margin}), total)"
        )
        weights = f"w{step}"
        sweep, rest = divmod(step, 3)
        if not rest and (sweep % _SWEEPS_PER_CHECK == 0 or sweep == most_sweeps):
            gaps = " union all ".join(
                f"select max(abs(share - now / whole)) as gap from (select {m}, sum(weight) as now"
                f" from {weights} group by {m}) join t_{m} using ({m}), (select sum(weight) as whole from {weights})"
                for m in MARGINS
            )
            checks.append((step, f"(select coalesce(max(gap), 0) from ({gaps}))"))
    chosen = " ".join(f"when {gap} <= {tolerance} then {step}" for step, gap in checks[:-1])
    chosen = f"case {chosen} else {checks[-1][0]} end"
    fitted = " union all ".join(
        f"select * from w{step} where (select step from chosen) = {step}" for step, _ in checks
    )
    targets = ",\n".join(
        f"t_{m} as (select {m}, raw / sum(raw) over () as share from (select {m},"
        f" case when sum(tokens) > 0 then pow(sum(tokens), {exponent}) end as raw"
        f" from cells group by {m}))"
        for m in MARGINS
    )
    return f"""
with docs as (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang,
    case
      when 50 * length(regexp_replace(text, '[^|]', '', 'g')) >= length(text) then 'table'
      when 20 * length(regexp_replace(text, '[^#*$%&]', '', 'g')) >= length(text) then 'symbols'
      when length(text) >= 8000 then 'long' else 'plain' end as topic,
    coalesce(len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')), 0) as tokens,
    ('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, md5(coalesce(text, '')))), 1, 12))
      ::bigint / pow(2, 48) as uniform
  from documents
),
cells as (
  select source, lang, topic, sum(tokens)::double as tokens from docs group by all
),
total as (select {rate} * sum(tokens) as budget from cells),
{targets},
w0 as (select *, tokens as weight from cells),
{",".join(chr(10) + step for step in steps)},
chosen as (select {chosen} as step),
scaled as (
  select source, lang, topic, case when tokens > 0 then round(weight / tokens, 9) else 0 end as p
  from ({fitted})
)
select doc_id, source, lang, topic, tokens::bigint as n_tokens,
  case when tokens > 0 then p else 0 end as p,
  uniform < case when tokens > 0 then p else 0 end as sampled
from docs join scaled using (source, lang, topic)
"""
