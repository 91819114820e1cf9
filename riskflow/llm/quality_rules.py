"""Quality rules with robust multivariate outliers, on DataFrame functions only.

Whole texts give counts of words, symbols, repeated lines and repeated word windows. Two
plain rules reject texts that are too short or repeat themselves. All others are vectors
of transformed statistics. For each language and source the minimum covariance
determinant gives a centre and a scatter that outliers can't pull. Four starts go through
concentration steps, each of which keeps the closest six tenths of the rows and estimates
anew. After two steps the start of the smallest determinant goes on, until its determinant
falls no further. A document is rejected if its squared Mahalanobis distance is beyond the
cutoff.

Each step is two grouped aggregates over a narrow table: an approximate quantile of the
distances, then moments of the rows within it. Estimates are one row per group and start.

Defined results: NULL text has no words; NULL languages and sources are values of their
own; groups of fewer than `min_rows` documents are put together by language, and
languages that are still too small with each other; a rest that is too small is judged by an
estimate over all documents, however few; statistics without any spread get the spread of a
floor; repeated rows and NULL ids are judged each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.words import WORD
from riskflow.sources.tables import stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Share of a group's rows that an estimate rests on.
SUPPORT = 0.6
#: Steps of all starts, and of the best one at most (the determinant stops falling before).
TRIAL_STEPS = 2
STEPS = 20
MIN_ROWS = 100
#: Upper 1e-8 quantile of chi-square with 4 degrees of freedom.
CUTOFF = 43.1
#: Makes the scatter of the closest 60 % of 4-variate normal rows that of all rows:
#: 0.6 / P(chi2 with 6 df <= the 0.6 quantile of chi2 with 4 df).
CONSISTENCY = 1.82
STATISTICS = ("x1", "x2", "x3", "x4")
#: Least standard deviation of each statistic, in its own unit.
FLOORS = (0.45, 0.35, 0.35, 0.05)
#: The group of documents whose own groups are too small, estimated over all documents.
EVERYTHING = "all"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def statistics(docs: DataFrame, id_col: str, text_col: str, keep: dict[str, str]) -> DataFrame:
    """Counts per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    `keep` maps further input columns to their names in the result. Arrays are columns
    of their own, each used more than once, so that Spark doesn't compute them per element.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = list(keep.values())
    base = docs.select(
        F.col(id_col).alias("id"),
        *[F.col(c).alias(n) for c, n in keep.items()],
        F.length(_without(text, SPACES)).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
    )
    n = F.size("words")
    counted = base.select(
        "id",
        *kept,
        n.cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), n - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("words", i, WINDOW)),
            ),
        ).alias("windows"),
    )
    counts = ["id", *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    # Windows in the order of their hashes; only texts that repeat one need it.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = counted.select(
        *counts,
        F.when(
            repeats,
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("s"),
    )
    hash_at = lambda k: F.get("s", k)["h"]
    twice = lambda k: F.coalesce(hash_at(k) == hash_at(k - 1), F.lit(False)) | F.coalesce(
        hash_at(k) == hash_at(k + 1), F.lit(False)
    )
    places = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("s") - 1), twice), lambda k: F.get("s", k)["i"]
    )
    placed = ordered.select(
        *counts, F.when(F.col("s").isNotNull(), F.sort_array(places)).alias("p")
    )
    gaps = F.aggregate(
        F.sequence(F.lit(1), F.size("p") - 1),
        F.lit(WINDOW),
        lambda total, k: total + F.least(F.lit(WINDOW), F.get("p", k) - F.get("p", k - 1)),
    )
    covered = F.when(F.col("p").isNotNull(), gaps).otherwise(0).cast("bigint")
    return placed.select(*counts, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    """Too few words, or too many of them in windows that the text repeats."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _vector() -> dict[str, Column]:
    """Mean word length; symbols, repeated lines (logarithms); share of repeated words."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "x1": F.col("word_chars") / words,
        "x2": F.log1p(100.0 * F.col("n_symbols") / chars),
        "x3": F.log1p(100.0 * F.col("n_dup_lines") / words),
        "x4": F.col("n_repeat_words") / words,
    }


def _grouped(rows: DataFrame, min_rows: int) -> DataFrame:
    """`rows` with `group`: language and source, or coarser where these have few rows.

    `EVERYTHING` if even the rest of all languages is too small.
    """
    fine = F.to_json(F.struct("lang", "source"))
    coarse = F.to_json(F.struct("lang"))
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    # From here on one row per language and source.
    small = F.col("n") < min_rows
    in_lang = F.sum(F.when(small, F.col("n")).otherwise(0)).over(W.partitionBy("lang"))
    group = F.when(~small, fine).when(F.col("in_lang") >= min_rows, coarse).otherwise("rest")
    names = sizes.withColumn("in_lang", in_lang).select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), group.alias("group"), "n"
    )
    names = stored(names, "groups")
    rest = names.filter(F.col("group") == "rest").agg(F.sum("n")).first()[0] or 0
    if rest < min_rows:
        names = names.replace("rest", EVERYTHING, ["group"])
    names = names.drop("n")
    same = rows["lang"].eqNullSafe(names["g_lang"]) & rows["source"].eqNullSafe(names["g_source"])
    return rows.join(names, same).drop("g_lang", "g_source")


def _cholesky(estimates: DataFrame, floors) -> DataFrame:
    """`group`, the centre m_i and the lower triangle l_ij of scatter + squared floors."""
    p = len(STATISTICS)
    for i in range(p):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}")
            if i == j:
                value = value + floors[i] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(floors[i] ** 2 * 1e-6)))
            else:
                value = value / F.col(f"l{j}{j}")
            estimates = estimates.withColumn(f"l{i}{j}", value)
    return estimates


def _distance(rows: DataFrame) -> DataFrame:
    """`rows`, joined with the estimate of their group, with the squared distance `d2`."""
    solved = []
    for i in range(len(STATISTICS)):
        value = F.col(STATISTICS[i]) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
        solved.append(F.col(f"z{i}") * F.col(f"z{i}"))
    total = solved[0]
    for z in solved[1:]:
        total = total + z
    return rows.withColumn("d2", total)


def _moments(rows: DataFrame, scale: float) -> DataFrame:
    """Centre and scaled scatter per group and start."""
    p = range(len(STATISTICS))
    centre = [F.avg(STATISTICS[i]).alias(f"m{i}") for i in p]
    scatter = [
        (F.covar_pop(STATISTICS[i], STATISTICS[j]) * scale).alias(f"c{i}{j}")
        for i in p
        for j in range(i + 1)
    ]
    return rows.groupBy("group", "start").agg(*centre, *scatter)


def _starts(rows: DataFrame, floors) -> DataFrame:
    """Four estimates per group: centre m_i and scatter c_ij, none of them final.

    0: medians and absolute deviations. 1: directions from the medians, lengths left out.
    2: deviations bent by tanh. 3: mean and covariance of all rows.
    """
    p = range(len(STATISTICS))
    pairs = [(i, j) for i in p for j in range(i + 1)]
    medians = stored(
        rows.groupBy("group").agg(
            *[F.percentile_approx(STATISTICS[i], 0.5, 2000).alias(f"m{i}") for i in p]
        ),
        "medians",
    )
    off = [F.abs(F.col(STATISTICS[i]) - F.col(f"m{i}")) for i in p]
    spread = rows.join(medians, "group").groupBy("group").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in p],
        *[
            F.greatest(F.percentile_approx(off[i], 0.5, 2000) * 1.4826, F.lit(floors[i])).alias(f"s{i}")
            for i in p
        ],
    )
    units = rows.join(stored(spread, "spread"), "group").withColumns(
        {f"z{i}": (F.col(STATISTICS[i]) - F.col(f"m{i}")) / F.col(f"s{i}") for i in p}
    )
    square = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in p), F.lit(0.0))
    units = units.withColumn("square", square)
    product = lambda i, j: F.col(f"z{i}") * F.col(f"z{j}")
    direction = lambda i, j: F.when(F.col("square") > 0, product(i, j) / F.col("square")).otherwise(0.0)
    sums = units.groupBy("group").agg(
        *[F.first(f"{c}{i}").alias(f"{c}{i}") for c in "ms" for i in p],
        *[F.avg(STATISTICS[i]).alias(f"a{i}") for i in p],
        *[F.avg(direction(i, j)).alias(f"u{i}{j}") for i, j in pairs],
        *[F.avg(F.tanh(f"z{i}") * F.tanh(f"z{j}")).alias(f"t{i}{j}") for i, j in pairs],
        *[F.covar_pop(STATISTICS[i], STATISTICS[j]).alias(f"v{i}{j}") for i, j in pairs],
    )
    unit = lambda i, j: F.col(f"s{i}") * F.col(f"s{j}")
    scatters = [
        lambda i, j: unit(i, j) if i == j else F.lit(0.0),
        lambda i, j: F.col(f"u{i}{j}") * len(STATISTICS) * unit(i, j),
        lambda i, j: F.col(f"t{i}{j}") * unit(i, j),
        lambda i, j: F.col(f"v{i}{j}"),
    ]
    starts = [
        F.struct(
            F.lit(k).alias("start"),
            *[F.col(f"{'a' if k == 3 else 'm'}{i}").alias(f"m{i}") for i in p],
            *[scatter(i, j).alias(f"c{i}{j}") for i, j in pairs],
        )
        for k, scatter in enumerate(scatters)
    ]
    return sums.select("group", F.inline(F.array(*starts)))


def _best(estimates: DataFrame, *by: str) -> DataFrame:
    """Of each `by` the estimate of the smallest determinant, of equal ones the earliest."""
    first = ["log_det", "step"]
    others = [c for c in estimates.columns if c not in (*by, *first)]
    least = estimates.groupBy(*by).agg(F.min(F.struct(*first, *others)).alias("e"))
    return least.select(*by, "e.*")


def robust_estimates(
    rows: DataFrame, support: float = SUPPORT, steps: int = STEPS, floors=FLOORS
) -> DataFrame:
    """Centre and Cholesky factor per `group` of rows with the statistics x1..x4.

    `log_det` is the logarithm of the determinant of scatter + squared floors.
    """
    p = range(len(STATISTICS))
    names = [f"m{i}" for i in p] + [f"l{i}{j}" for i in p for j in range(i + 1)]
    log_det = F.round(2 * sum((F.log(f"l{i}{i}") for i in p), F.lit(0.0)), 9)
    estimates = stored(
        _cholesky(_starts(rows, floors), floors).select(
            "group", "start", F.lit(float("inf")).alias("log_det"), F.lit(0).alias("step"), *names
        ),
        "estimates",
    )
    for step in range(1, steps + 1):
        falling = estimates.filter(F.col("step") == step - 1)
        if falling.isEmpty():
            break
        nearest = _distance(rows.join(falling, "group")).groupBy("group", "start").agg(
            F.percentile_approx("d2", support, 2000).alias("limit")
        )
        limits = stored(falling.join(nearest, ["group", "start"]), "limits")
        core = _distance(rows.join(limits, "group")).filter(F.col("d2") <= F.col("limit"))
        moved = _cholesky(_moments(core, CONSISTENCY), floors).select(
            "group", "start", log_det.alias("log_det"), F.lit(step).alias("step"), *names
        )
        best = _best(estimates.unionByName(moved), "group", "start")
        estimates = stored(_best(best, "group") if step == TRIAL_STEPS else best, "estimates")
    return _best(estimates, "group").select("group", "log_det", *names)


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cutoff: float = CUTOFF,
    min_rows: int = MIN_ROWS,
    support: float = SUPPORT,
    steps: int = STEPS,
) -> DataFrame:
    """Counts, base_failed, the squared distance `d2` (NULL if the rules reject) and kept."""
    counts = statistics(docs, id_col, text_col, {lang_col: "lang", source_col: "source"})
    counts = stored(counts.withColumn("base_failed", base_failed()), "statistics")
    good = counts.filter(~F.col("base_failed")).withColumns(_vector())
    sizes = _grouped(good, min_rows)
    rows = stored(sizes.select("id", "lang", "source", "group", *STATISTICS), "vectors")
    fitted, apart = rows, F.col("group") == EVERYTHING
    if not rows.filter(apart).isEmpty():
        fitted = rows.filter(~apart).unionByName(rows.withColumn("group", F.lit(EVERYTHING)))
    estimates = stored(robust_estimates(fitted, support, steps), "estimates")

    # Documents that passed the rules get the group of their language and source again.
    named = stored(rows.select("lang", "source", "group").distinct(), "names")
    per_source = stored(
        named.join(estimates, "group").select(
            F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
            *[f"m{i}" for i in range(4)], *[f"l{i}{j}" for i in range(4) for j in range(i + 1)],
        ),
        "per-source",
    )
    same = counts["lang"].eqNullSafe(per_source["g_lang"]) & counts["source"].eqNullSafe(
        per_source["g_source"]
    )
    measured = _distance(counts.withColumns(_vector()).join(per_source, same, "left"))
    d2 = F.when(~F.col("base_failed"), F.col("d2"))
    result = measured.withColumn("d2", d2)
    return result.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"),
        "d2",
    )
