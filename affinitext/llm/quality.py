"""Quality rules: two fixed limits, then robust multivariate outliers.

For every language and source, the minimum covariance determinant estimate of transformed
text statistics is found by concentration steps: from a robust start, keep the share of
documents nearest to the centre, take their mean and covariance, and measure again.
Documents too far from the final centre, by Mahalanobis distance, are rejected. All of it is
DataFrame functions; groups of any size cost a partial aggregate each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinitext.llm.common import KEY, SPACES, stored, text_of, with_key

MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
#: Share of a group that its centre and spread are taken from.
CORE = 0.75
STEPS = 4
#: Rarer sources of a language are judged together, rarer languages too.
MIN_GROUP = 100
#: Squared distance beyond which a document is an outlier: the 0.99 quantile of the
#: chi-squared distribution with as many degrees of freedom as there are statistics (5).
CUTOFF = 15.09
#: A share of CORE nearest points of a normal sample understates its covariance by this factor.
CONSISTENCY = 1.41
#: Least standard deviations, for statistics that vary less than this in a group.
STATS = {"length": 0.75, "word_length": 0.1, "symbols": 0.7, "duplicates": 0.7, "repeats": 0.8}


def base_measures(docs: DataFrame) -> DataFrame:
    """`docs` plus `_n_words`, `_word_chars`, `_n_symbols`, `_n_dup_lines`, `_n_repeat_words`."""
    text = F.col("_text")
    spaced = F.trim(F.translate(text, SPACES, " " * len(SPACES)))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, SPACES, " " * 6)) != "")
    step = docs.withColumn("_text", text_of()).withColumns(
        {
            "_words": F.when(spaced != "", F.split(spaced, " +")),
            "_word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
            "_n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "_lines": F.when(F.instr(text, "\n") > 0, lines),
        }
    ).withColumns(
        {
            "_n_words": F.coalesce(F.size("_words"), F.lit(0)).cast("long"),
            "_n_dup_lines": F.coalesce(
                F.size("_lines") - F.size(F.array_distinct("_lines")), F.lit(0)
            ).cast("long"),
            "_windows": F.when(
                F.size("_words") >= WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("_words", i, WINDOW)),
                ),
            ),
        }
    )
    # Only texts with a window twice go on; they sort their windows with their places.
    again = F.size("_windows") > F.size(F.array_distinct("_windows"))
    step = step.withColumn(
        "_sorted",
        F.when(again, F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))),
    ).withColumn(
        "_places",
        F.expr(
            "array_sort(transform(filter(_sorted, (e, j) -> (j > 0 and _sorted[j - 1].w = e.w)"
            " or (j + 1 < size(_sorted) and _sorted[j + 1].w = e.w)), e -> e.i))"
        ),
    )
    covered = F.expr(
        f"aggregate(_places, named_struct('n', 0L, 'last', {-WINDOW}), (a, i) -> named_struct("
        f"'n', a.n + least({WINDOW}, i - a.last), 'last', i), a -> a.n)"
    )
    return step.withColumn("_n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_text", "_words", "_lines", "_windows", "_sorted", "_places"
    )


def _statistics() -> dict[str, Column]:
    words = F.greatest(F.col("_n_words"), F.lit(1))
    chars = F.greatest(F.col("_word_chars"), F.lit(1))
    return {
        "length": F.log1p("_n_words"),
        "word_length": F.log(chars / words),
        "symbols": F.log1p(F.col("_n_symbols") * 1000 / chars),
        "duplicates": F.log1p("_n_dup_lines"),
        "repeats": F.log1p(F.col("_n_repeat_words") * 100 / words),
    }


def _distance(rows: DataFrame) -> DataFrame:
    """`rows` plus `_d2`, by forward substitution with the group's triangular factor."""
    names = list(STATS)
    for i, x in enumerate(names):
        z = F.col(f"_x_{x}") - F.col(f"_m_{x}")
        for j in range(i):
            z = z - F.col(f"_l_{i}_{j}") * F.col(f"_z_{j}")
        rows = rows.withColumn(f"_z_{i}", z / F.col(f"_l_{i}_{i}"))
    zs = [F.col(f"_z_{i}") for i in range(len(names))]
    return rows.withColumn("_d2", sum((z * z for z in zs[1:]), zs[0] * zs[0])).drop(
        *[f"_z_{i}" for i in range(len(names))]
    )


def _factor(groups: DataFrame) -> DataFrame:
    """Means and the Cholesky factor per group, from means `_m_*` and covariances `_c_i_j`."""
    k = range(len(STATS))
    for i in k:
        for j in range(i + 1):
            rest = F.col(f"_c_{i}_{j}")
            for t in range(j):
                rest = rest - F.col(f"_l_{i}_{t}") * F.col(f"_l_{j}_{t}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"_l_{j}_{j}")
            groups = groups.withColumn(f"_l_{i}_{j}", value)
    return groups.select(
        "_group", *[f"_m_{x}" for x in STATS], *[f"_l_{i}_{j}" for i in k for j in range(i + 1)]
    )


def _spread(variance: Column, name: str) -> Column:
    return F.greatest(variance, F.lit(STATS[name] ** 2))


def estimates(rows: DataFrame, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """Centre and triangular factor of every `_group` of `rows` with statistics `_x_*`."""
    names = list(STATS)
    middle = rows.groupBy("_group").agg(
        *[F.percentile_approx(f"_x_{x}", F.array(F.lit(0.5), F.lit(0.25), F.lit(0.75)), 1000)
          .alias(f"_q_{x}") for x in names]
    )
    start = middle.select(
        "_group", *[F.col(f"_q_{x}")[0].alias(f"_m_{x}") for x in names],
        *[
            (_spread(F.pow((F.col(f"_q_{x}")[2] - F.col(f"_q_{x}")[1]) / 1.349, 2), x)
             if i == j else F.lit(0.0)).alias(f"_c_{i}_{j}")
            for i, x in enumerate(names) for j in range(i + 1)
        ],
    )
    found = stored(_factor(start))
    for _ in range(steps):
        near = _distance(rows.join(found, "_group"))
        limits = near.groupBy("_group").agg(F.percentile_approx("_d2", core, 1000).alias("_limit"))
        limits = stored(found.join(limits, "_group"))
        inner = _distance(rows.join(limits, "_group")).filter("_d2 <= _limit")
        # Products are taken about the last centre, so that no digits are lost.
        moments = inner.select(
            "_group", *[(F.col(f"_x_{x}") - F.col(f"_m_{x}")).alias(f"_y_{x}") for x in names],
            *[f"_m_{x}" for x in names],
        ).groupBy("_group").agg(
            *[F.first(f"_m_{x}").alias(f"_o_{x}") for x in names],
            *[F.avg(f"_y_{x}").alias(f"_a_{x}") for x in names],
            *[F.avg(F.col(f"_y_{x}") * F.col(f"_y_{y}")).alias(f"_p_{i}_{j}")
              for i, x in enumerate(names) for j, y in enumerate(names[: i + 1])],
        )
        found = stored(_factor(moments.select(
            "_group", *[(F.col(f"_o_{x}") + F.col(f"_a_{x}")).alias(f"_m_{x}") for x in names],
            *[
                (_spread(c, x) if i == j else c).alias(f"_c_{i}_{j}")
                for i, j, x, c in (
                    (i, j, x, (F.col(f"_p_{i}_{j}") - F.col(f"_a_{x}") * F.col(f"_a_{y}")) * CONSISTENCY)
                    for i, x in enumerate(names) for j, y in enumerate(names[: i + 1])
                )
            ],
        )))
    return found


MEASURES = ["_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words"]


def verdicts(
    docs: DataFrame, cutoff: float = CUTOFF, core: float = CORE, steps: int = STEPS,
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """One row per document: doc_id, its key, measures, `_base_failed`, `_d2` and `_kept`.

    A null text has no words and fails; null languages and sources are groups of their own;
    repeated rows are judged alike; an empty table gives no rows. Statistics that hardly vary
    in a group get a least spread (`STATS`), so a group of equal documents rejects none.
    Texts are read once; the measures are written to the shared folder.
    """
    measured = stored(
        base_measures(with_key(docs.select("doc_id", "text", "lang", "source"), "lang", "source"))
        .drop("text")
    )
    failed = (F.col("_n_words") < MIN_WORDS) | (
        F.col("_n_repeat_words") * 100 > F.col("_n_words") * REPEAT_PERCENT
    )
    rows = measured.select(
        "doc_id", *KEY, *MEASURES, failed.alias("_base_failed"),
        F.to_json(F.struct("lang")).alias("_l"), F.to_json(F.struct("lang", "source")).alias("_ls"),
        *[x.alias(f"_x_{name}") for name, x in _statistics().items()],
    )
    passed = rows.filter(~F.col("_base_failed"))
    sources = passed.groupBy("_l", "_ls").agg(F.count("*").alias("_n"))
    small = F.col("_n") < min_group
    languages = sources.filter(small).groupBy("_l").agg(F.sum("_n").alias("_n_l"))
    groups = sources.join(languages, "_l", "left").select(
        "_ls",
        F.when(~small, F.concat(F.lit("both"), "_ls"))
        .when(F.col("_n_l") >= min_group, F.concat(F.lit("lang"), "_l"))
        .otherwise("all").alias("_group"),
    )
    grouped = stored(passed.join(groups, "_ls"))
    judged = _distance(grouped.join(estimates(grouped, core, steps), "_group"))
    columns = ["doc_id", *KEY, *MEASURES, "_base_failed"]
    return judged.select(*columns, "_d2", (F.col("_d2") <= cutoff).alias("_kept")).unionByName(
        rows.filter("_base_failed").select(
            *columns, F.lit(None).cast("double").alias("_d2"), F.lit(False).alias("_kept")
        )
    )


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The documents that pass, with all their columns."""
    rejected = verdicts(docs, **settings).filter(~F.col("_kept")).select(*KEY).distinct()
    keyed = with_key(docs, "lang", "source")
    return keyed.join(rejected, KEY, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
