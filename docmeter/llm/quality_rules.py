"""Weak supervision: rules vote or abstain, EM estimates them, a posterior decides.

DataFrame functions only. Each text is read once: its statistics are computed
inside the row (arrays and higher-order functions; nothing is exploded, so no
text or word heats a task) and written as a narrow table. The votes of all rows
are counted by pattern; a table of at most 3**rules rows, whatever the input, goes
to the driver, where expectation-maximisation estimates for either class how
often each rule votes good, bad or not at all. A row's posterior is then a
sum of constants picked by its votes.

Defined results: null text counts as empty, has 0 in every statistic and fails
the base. Repeated rows are judged alike. On an empty table nothing is
estimated and nothing returned. Result columns replace columns of that name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmeter.llm.common import BLANKS, small, table, text_of, unused, written

SYMBOLS = r"[#*$%&|<>]"
#: Ends of sentences in many scripts: Latin, Armenian, Arabic, Urdu, Devanagari, Tibetan, Burmese, Ethiopic, Khmer, CJK, full and half width.
ENDS = r".!?\u0589\u061F\u06D4\u0964\u0965\u0F0D\u0F0E\u104A\u104B\u1362\u1367\u1368\u17D4\u17D5\u2026\u203C\u2047-\u2049\u3002\uFF01\uFF0E\uFF1F\uFF61"
#: Other punctuation of prose: quotes, dashes, apostrophes, openers, commas and colons of other scripts.
PAUSES = r"\p{Pi}\p{Pf}\p{Pd},;:'\"()\u00A1\u00B7\u00BF\u055A-\u055E\u05BE\u05F3\u05F4\u060C\u061B\u066A-\u066C\u0F0B\u0F0C\u1361\u1363-\u1366\u17D6\u201A\u201E\u3001\u3008-\u3011\u3014-\u301B\u30FB\uFF08\uFF09\uFF0C\uFF1A\uFF1B\uFF62-\uFF65"
#: Runs of what prose seldom holds: neither letters with their marks and joiners, digits, white space nor punctuation of prose.
ODD_RUN = rf"[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Z}}\s\u200B-\u200F\u00AD{ENDS}{PAUSES}]+"
#: What most prose is made of and no count below looks for; runs of it become a blank before the patterns that know many scripts are tried.
PLAIN_RUN = r"[A-Za-z0-9\s,;:'\"()\-]+"
WINDOW = 5
_TRIM = " \t\n\x0b\x0c\r"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_letters", "n_stops", "n_bangs", "n_odd_runs")


def repeated_window_words(words: str, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the array column ``words``."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(window)]))

    def let(value: Column, f) -> Column:  # evaluates value once
        return F.get(F.transform(F.array(value), f), F.lit(0))

    def places(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return let(
            ranked,
            lambda r: F.sort_array(
                F.filter(
                    F.transform(r, lambda x, k: F.when((F.get(r, k - 1)["h"] == x["h"]) | (F.get(r, k + 1)["h"] == x["h"]), x["p"])),
                    lambda p: p.isNotNull(),
                )
            ),
        )

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(places(h), covered)))
    return F.when(F.size(words) < window, F.lit(0)).otherwise(found)


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the columns of STATISTICS, all long."""
    whole, trim, words, lines, rest = unused(df, "whole", "trim", "words", "lines", "rest")

    def removed(pattern: str, of: str = whole) -> Column:
        return F.char_length(of) - F.char_length(F.regexp_replace(of, pattern, ""))

    rows = df.withColumn(whole, text_of(text)).withColumn(rest, F.regexp_replace(whole, PLAIN_RUN, " ")).withColumn(trim, F.btrim(whole, F.lit(_TRIM)))
    rows = rows.withColumn(words, F.when(F.col(trim) == "", F.array().cast("array<string>")).otherwise(F.split(trim, BLANKS)))
    rows = rows.withColumn(lines, F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(_TRIM)) != ""))
    values = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": removed(SYMBOLS, rest),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_window_words(words),
        "n_distinct_words": F.size(F.array_distinct(words)),
        "n_upper": removed(r"\p{Lu}+"),
        "n_letters": removed(r"\p{L}+"),
        "n_stops": removed(f"[{ENDS}]", rest),
        "n_bangs": removed("!+", rest),
        "n_odd_runs": F.regexp_count(rest, F.lit(ODD_RUN)),
    }
    kept = [c for c in df.columns if c not in values]
    return rows.select(*kept, *[v.cast("long").alias(k) for k, v in values.items()])


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules() -> dict[str, tuple[Column, Column]]:
    """Name: when it votes bad, when it votes good; neither: it abstains. Ratios are over at least 1."""
    words, letters = F.greatest("n_words", F.lit(1)), F.greatest("n_letters", F.lit(1))
    never = F.lit(False)
    return {
        "symbols": (10 * F.col("n_symbols") > words, never),
        "odd_runs": (6 * F.col("n_odd_runs") > words, 20 * F.col("n_odd_runs") <= words),
        "bangs": (5 * F.col("n_bangs") > words, never),
        "capitals": (10 * F.col("n_upper") > 4 * letters, never),
        "repeats": (100 * F.col("n_repeat_words") > 15 * words, never),
        "lines": ((F.col("n_lines") > 3) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")), never),
        "variety": ((F.col("n_words") >= 40) & (10 * F.col("n_distinct_words") < words), never),
        "stops": ((F.col("n_words") >= 30) & (100 * F.col("n_stops") < words), (100 * F.col("n_stops") >= 2 * words) & (2 * F.col("n_stops") <= words)),
    }


def votes() -> list[Column]:
    """A vote of each rule: 0 bad, 1 abstains, 2 good."""
    return [F.when(bad, 0).when(good, 2).otherwise(1) for bad, good in rules().values()]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> tuple[float, list[list[list[float]]]]:
    """Prior log-odds of good, and per rule and class (bad, good) the log-shares of votes, by EM over vote patterns.

    The start takes a row for bad if a rule does. Shares are smoothed by one row.
    Most rules never vote good, so a row that one kind of fault marks isn't
    outvoted by rules for other kinds.
    """
    if not patterns:
        return 0.0, []
    n_rules = len(patterns[0][0])
    good = [0.95 if 0 not in votes else 0.05 for votes, _ in patterns]
    model: tuple[float, list[list[list[float]]]] = (0.0, [])
    for _ in range(rounds):
        mass = [sum(c * (1 - g) for (_, c), g in zip(patterns, good, strict=True)), sum(c * g for (_, c), g in zip(patterns, good, strict=True))]
        shares = [[[1.0 / 3] * 3 for _ in range(2)] for _ in range(n_rules)]
        for (votes, c), g in zip(patterns, good, strict=True):
            for r, v in enumerate(votes):
                shares[r][0][v] += c * (1 - g)
                shares[r][1][v] += c * g
        logs = [[[math.log(x / (m + 1)) for x in cls] for cls, m in zip(rule, mass, strict=True)] for rule in shares]
        model = (math.log((mass[1] + 1) / (mass[0] + 1)), logs)
        new = []
        for votes, _ in patterns:
            odds = model[0] + sum(logs[r][1][v] - logs[r][0][v] for r, v in enumerate(votes))
            new.append(1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))))
        moved = max(abs(a - b) for a, b in zip(new, good, strict=True))
        good = new
        if moved < 1e-9:
            break
    return model


def posterior(model: tuple[float, list[list[list[float]]]]) -> Column:
    """P(good | votes) as a sum of constants."""
    odds = F.lit(model[0])
    for vote, (bad, good) in zip(votes(), model[1], strict=False):
        for v in range(3):
            odds = odds + F.when(vote == v, F.lit(good[v] - bad[v])).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge_quality(df: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows without the text, with statistics, base_failed, quality_posterior and kept.

    Rows that fail the base are not kept and don't count in the estimate.
    """
    stats = text_statistics(df, text)
    stats = stats.select(*[c for c in stats.columns if c not in (text, "base_failed", "quality_posterior", "kept")], base_failed().alias("base_failed"))
    stats = written(stats, "quality-stats")
    voted = stats.where(~F.col("base_failed")).select(*[v.alias(name) for v, name in zip(votes(), rules(), strict=True)])
    counts = voted.groupBy(*rules()).count().collect()  # at most 3**8 rows
    model = estimate(sorted((tuple(row[:-1]), row[-1]) for row in counts))
    judged = stats.withColumn("quality_posterior", posterior(model))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality_posterior") >= least))


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept. Texts aren't written: verdicts come back by two hashes of the row."""
    row, row2 = unused(df, "row", "row2")
    keyed = df.select("*", F.xxhash64(*df.columns).alias(row), F.xxhash64(*reversed(df.columns), F.lit(1)).alias(row2))
    judged = judge_quality(keyed.select(F.col(row).alias("row"), F.col(row2).alias("row2"), F.col(text).alias("text")))
    rejected = written(judged.where("not kept").select(F.col("row").alias(row), F.col("row2").alias(row2)).distinct(), "rejected")
    return keyed.join(small(rejected), [row, row2], "left_anti").select(*df.columns)


def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: statistics and verdict of every whole text of ``documents``."""
    judged = judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_posterior")
