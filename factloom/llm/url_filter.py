"""URL filter (10): rules first; the rest by two character models, of accepted and rejected URLs.

The models are smoothed Markov models of variable order: the chance of a character is
interpolated from the longest context seen down to none (Witten-Bell), so each character
uses the longest history that the corpus knows. They learn from the URLs that the rules
decide. A URL goes by the difference of its two log likelihoods, divided by its length,
against the threshold that parts the decided URLs best. Everything is DataFrame work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import join_values, query, stored, table

# (host suffix, path beginning, verdict)
Rule = tuple[str, str, str]
DEFAULT_RULES: tuple[Rule, ...] = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START = "\x02"
CLASSES = ("allow", "block")


@dataclass(frozen=True)
class Settings:
    """`order`: characters of context at most. `alphabet`: size assumed for unseen characters.
    `step`: distance of the thresholds tried."""

    order: int = 4
    alphabet: int = 256
    step: float = 0.005


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first `://`: the host up to `/`, `?`, `#`, A-Z lowered; the path up to `?`, `#`."""
    known = F.coalesce(url, F.lit(""))
    at = F.instr(known, "://")
    rest = F.when(at > 0, F.substr(known, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null when none does.

    A rule fits its host and all subdomains of it, when the path starts with the rule's.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        answer = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, answer).otherwise(chosen)
    return chosen


def grams(rows: DataFrame, settings: Settings, *keep: str) -> DataFrame:
    """One row per place of a url: the character there with `order` characters before it.

    The url is closed by its end, and begun by `order` start marks.
    """
    width = settings.order + 1
    padded = F.concat(F.lit(START * settings.order), F.col("url"), F.lit("\x03"))
    places = F.sequence(F.lit(1), F.char_length("url") + 1)
    cut = F.transform(places, lambda k: F.substr(padded, k, F.lit(width)))
    return rows.select(*keep, F.explode(cut).alias("gram"))


def train(urls: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """(gram, uses, ratio), and the number of all uses.

    `urls` has url (distinct), verdict (null where no rule decides) and n, its number of
    pages. `ratio` is the log chance of the gram's last character after the others under
    the accepted URLs minus that under the rejected ones.
    """
    spark, order = urls.sparkSession, settings.order
    seen = [F.sum(F.when(F.col("verdict") == c, F.col("n")).otherwise(0)).alias(c) for c in CLASSES]
    counts = grams(urls, settings, "verdict", "n").groupBy("gram").agg(
        F.count(F.lit(1)).alias("uses"), *seen
    )
    counts = stored(spark, counts, "grams")
    lower = None
    # From single characters up: each level leans on the one with a shorter context.
    for k in range(order + 1):
        sums = [F.sum(c).alias(c) for c in CLASSES]
        level = counts.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("gram")).agg(*sums)
        context = Window.partitionBy(F.substring("gram", 1, k))
        level = level.select(
            "gram",
            *CLASSES,
            *[F.sum(c).over(context).alias(f"{c}_all") for c in CLASSES],
            *[F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"{c}_kinds") for c in CLASSES],
        )
        base = {c: F.lit(1.0 / settings.alphabet) for c in CLASSES}
        if k:
            under = lower.select(F.col("gram").alias("shorter"), *[F.col(f"{c}_p") for c in CLASSES])
            level = level.withColumn("shorter", F.substring("gram", 2, k)).join(under, "shorter")
            base = {c: F.col(f"{c}_p") for c in CLASSES}
        chances = []
        for c in CLASSES:
            every, kinds = F.col(f"{c}_all"), F.col(f"{c}_kinds")
            # After a context that was never seen, the shorter one decides alone.
            chance = F.when(every == 0, base[c]).otherwise(
                (F.col(c) + kinds * base[c]) / (every + kinds)
            )
            chances.append(chance.alias(f"{c}_p"))
        lower = stored(spark, level.select("gram", *chances), f"order{k}")
    ratio = (F.log("allow_p") - F.log("block_p")).alias("ratio")
    model = stored(
        spark, lower.join(counts.select("gram", "uses"), "gram").select("gram", "uses", ratio), "ratios"
    )
    return model, model.agg(F.sum("uses")).first()[0] or 0


def threshold(scored: DataFrame, settings: Settings) -> float:
    """The score that parts the URLs of the two verdicts best, both kinds weighing alike.

    Scores are counted in steps, so what is sorted here depends on their range alone; 0 when
    one of the kinds has no URL.
    """
    decided = scored.filter(F.col("verdict").isNotNull())
    steps = decided.groupBy(F.floor(F.col("score") / settings.step).alias("at")).agg(
        *[F.sum(F.when(F.col("verdict") == c, F.col("n")).otherwise(0)).alias(c) for c in CLASSES]
    )
    below, every = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    # Accepted from this step on, rejected below it.
    right = F.sum("allow").over(every) - F.coalesce(F.sum("allow").over(below), F.lit(0))
    wrong = F.coalesce(F.sum("block").over(below), F.lit(0))
    quality = right / F.sum("allow").over(every) + wrong / F.sum("block").over(every)
    both = (F.sum("allow").over(every) > 0) & (F.sum("block").over(every) > 0)
    best = (
        steps.select("at", F.when(both, F.round(quality, 9)).alias("quality"))
        .filter(F.col("quality").isNotNull())
        .orderBy(F.desc("quality"), F.abs("at"), "at").select("at").first()
    )
    return best[0] * settings.step if best else 0.0


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    settings: Settings = Settings(),
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per row of `pages`: key, host, path, rule, verdict, score.

    The verdict is the rule's; without a rule it is `allow` from the threshold on. A null URL
    counts as empty. Nulls and repeats in the key pass through, equal URLs get equal verdicts;
    with no decided URL every score is 0 and all is allowed. Other columns are not read.
    """
    spark = pages.sparkSession
    known = pages.select(F.col(key).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    distinct = known.groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    distinct = distinct.select("url", "n", host.alias("host"), path.alias("path"))
    distinct = distinct.withColumn("ruled", ruled(F.col("host"), F.col("path"), rules))
    urls = stored(spark, distinct.select("url", "n", "host", "path", "ruled.*"), "urls")
    model, uses = train(urls, settings)
    scores = (
        join_values(grams(urls, settings, "url"), model, "gram", "uses", uses)
        .groupBy("url").agg(F.avg("ratio").alias("score"))
    )
    scored = stored(spark, urls.join(scores, "url"), "scored")
    least = threshold(scored, settings)
    verdict = F.coalesce("verdict", F.when(F.col("score") >= least, "allow").otherwise("block"))
    answers = scored.select("url", "n", "host", "path", "rule", verdict.alias("verdict"), "score")
    total = urls.agg(F.sum("n")).first()[0] or 0
    judged = join_values(known, answers, "url", "n", total)
    return judged.select(F.col("key").alias(key), "host", "path", "rule", "verdict", "score")


def twin(rules: tuple[Rule, ...], settings: Settings) -> str:
    """The same in SQL."""
    order = settings.order
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [
        f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{start}')"
        for name, start, _ in ordered
    ]
    rule = " ".join(f"{f} THEN '{r[0] + r[1]}'" for f, r in zip(fits, ordered, strict=True))
    verdict = " ".join(f"{f} THEN '{r[2]}'" for f, r in zip(fits, ordered, strict=True))
    levels = []
    for k in range(order + 1):
        lower = f"JOIN level{k - 1} s ON s.gram = substr(g.gram, 2, {k})" if k else ""
        parts = []
        for c in CLASSES:
            base = f"s.{c}_p" if k else f"(1.0::DOUBLE / {settings.alphabet})"
            parts.append(
                f"CASE WHEN {c}_all = 0 THEN {base} ELSE "
                f"({c} + {c}_kinds * {base}) / ({c}_all + {c}_kinds)::DOUBLE END AS {c}_p"
            )
        levels.append(
            f"""level{k} AS (
              SELECT g.gram, {", ".join(parts)} FROM (
                SELECT gram, allow, block,
                  sum(allow) OVER w AS allow_all, sum(block) OVER w AS block_all,
                  sum((allow > 0)::INT) OVER w AS allow_kinds, sum((block > 0)::INT) OVER w AS block_kinds
                FROM (SELECT substr(gram, {order + 1 - k}, {k + 1}) AS gram,
                        sum(allow) AS allow, sum(block) AS block FROM counts GROUP BY 1)
                WINDOW w AS (PARTITION BY substr(gram, 1, {k}))) g {lower})"""
        )
    return f"""
    WITH known AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
    rest AS (SELECT url, n, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
             ELSE '' END AS rest FROM (SELECT url, count(*) AS n FROM known GROUP BY url)),
    cut AS (SELECT url, n, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    urls AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS verdict FROM cut),
    places AS (SELECT url, n, verdict, unnest(list_transform(range(1, length(url) + 2), lambda k:
               substr(repeat(chr(2), {order}) || url || chr(3), k, {order + 1}))) AS gram FROM urls),
    counts AS (SELECT gram, sum(CASE WHEN verdict = 'allow' THEN n ELSE 0 END) AS allow,
               sum(CASE WHEN verdict = 'block' THEN n ELSE 0 END) AS block FROM places GROUP BY gram),
    {", ".join(levels)},
    scored AS (SELECT url, avg(ln(allow_p) - ln(block_p)) AS score
               FROM places JOIN level{order} USING (gram) GROUP BY url),
    steps AS (SELECT CAST(floor(score / {settings.step}) AS BIGINT) AS step,
              sum(CASE WHEN verdict = 'allow' THEN n ELSE 0 END) AS allow,
              sum(CASE WHEN verdict = 'block' THEN n ELSE 0 END) AS block
              FROM urls JOIN scored USING (url) WHERE verdict IS NOT NULL GROUP BY 1),
    tried AS (SELECT step, round((sum(allow) OVER () - coalesce(sum(allow) OVER b, 0)) / (sum(allow) OVER ())::DOUBLE
              + coalesce(sum(block) OVER b, 0) / (sum(block) OVER ())::DOUBLE, 9) AS quality,
              sum(allow) OVER () > 0 AND sum(block) OVER () > 0 AS both_kinds FROM steps
              WINDOW b AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    least AS (SELECT coalesce((SELECT step * {settings.step}::DOUBLE FROM tried WHERE both_kinds
              ORDER BY quality DESC, abs(step), step LIMIT 1), 0.0) AS least)
    SELECT page_id, host, path, rule,
           coalesce(verdict, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict
    FROM known JOIN urls USING (url) JOIN scored USING (url) CROSS JOIN least
    """


@query("op10_url_filter", twin(DEFAULT_RULES, Settings()))
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages")).drop("score")
