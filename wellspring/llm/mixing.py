"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations.

Documents fall into cells of source, language and topic. Raking scales the cells' token weights
to each marginal's targets in turn until all three hold together; what a cell weighs against
the tokens it has is then the rate at which its documents are sampled. Cells are the only thing
that is aggregated and shuffled; documents are read twice and joined with their cell's rate.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.common import keeps_columns
from wellspring.workspace import stage

DIMENSIONS = ("source", "lang", "topic")

#: Topics by what a text contains, in order; the rest is prose.
TOPICS = {
    "legal": ("License", "license", "Copyright"),
    "contact": ("@",),
    "table": (" | ",),
    "markup": ("***", "###"),
}


@dataclass(frozen=True)
class Targets:
    """``shares``: given weights of a dimension's values; values it doesn't name keep their
    own tokens. ``flatten``: exponent on the shares of a dimension that isn't given, 1 for
    as they are and 0 for all alike. ``sweeps``: passes over the three marginals. ``spare``: share
    of the weight whose cells may be too small to be sampled at their rate; they are taken whole."""

    shares: dict[str, dict[str, float]] = field(default_factory=dict)
    flatten: dict[str, float] = field(default_factory=lambda: {"source": 0.8, "lang": 0.7, "topic": 0.9})
    sweeps: int = 10
    spare: float = 0.02
    seed: str = "mix"


def topic_of(text: Column) -> Column:
    found = F.lit("prose")
    for name, marks in reversed(TOPICS.items()):
        held = F.lit(False)
        for mark in marks:
            held = held | F.contains(text, F.lit(mark))
        found = F.when(held, name).otherwise(found)
    return found


def tokens_of(text: Column) -> Column:
    """Spaces and line feeds, and one; none in an empty text."""
    bare = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return F.when(F.length(text) == 0, 0).otherwise(F.length(text) - F.length(bare) + 1).cast("long")


def placed(docs: DataFrame) -> DataFrame:
    """(doc_id, cell columns, mix_tokens); null and empty values of a dimension are one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        *[F.coalesce(d, F.lit("")).alias(f"mix_{d}") for d in ("source", "lang")],
        topic_of(text).alias("mix_topic"),
        tokens_of(text).alias("mix_tokens"),
    )


def cells(rows: DataFrame, targets: Targets) -> DataFrame:
    """Cells with their tokens and the target share of each of their three values."""
    keys = [f"mix_{d}" for d in DIMENSIONS]
    table = stage(rows.groupBy(*keys).agg(F.sum("mix_tokens").alias("tokens")).where("tokens > 0"), "mix-cells")
    for d in DIMENSIONS:
        own = table.groupBy(f"mix_{d}").agg(F.sum("tokens").cast("double").alias("of_value"))
        if d in targets.shares:
            wanted = F.lit(None).cast("double")
            for value, share in targets.shares[d].items():
                wanted = F.when(F.col(f"mix_{d}") == value, F.lit(float(share))).otherwise(wanted)
            all_own = own.agg(F.sum("of_value")).first()[0] or 1.0
            wish = own.select(f"mix_{d}", F.coalesce(wanted, F.col("of_value") / F.lit(all_own)).alias("wish"))
        else:
            wish = own.select(f"mix_{d}", F.pow("of_value", F.lit(targets.flatten.get(d, 1.0))).alias("wish"))
        total = wish.agg(F.sum("wish")).first()[0] or 1.0
        table = table.join(wish.withColumn(f"to_{d}", F.col("wish") / F.lit(total)).drop("wish"), f"mix_{d}")
    return table


def raked(table: DataFrame, sweeps: int) -> DataFrame:
    """``table`` with weight: token shares scaled to the three marginals in turn."""
    total = table.agg(F.sum("tokens")).first()[0] or 1
    table = table.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for sweep in range(sweeps):
        for d in DIMENSIONS:
            now = table.groupBy(f"mix_{d}").agg(F.sum("weight").alias("now"))
            table = table.join(now, f"mix_{d}").withColumn("weight", F.col("weight") * F.col(f"to_{d}") / F.col("now")).drop("now")
        table = stage(table, f"mix-sweep-{sweep}")
    return table


def rates(rows: DataFrame, targets: Targets) -> DataFrame:
    """Each cell's sampling probability: its weight for a token, over the rate that all but
    cells of ``spare`` weight keep below. Rates are told apart in steps of a sixteenth power of
    two, so the steps to be ordered are few however many cells there are."""
    table = raked(cells(rows, targets), targets.sweeps)
    rate = F.col("weight") / F.col("tokens")
    steps = table.groupBy(F.floor(F.log2(rate) * 16).alias("step")).agg(F.sum("weight").alias("w"))
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("over", F.coalesce(F.sum("w").over(above), F.lit(0.0)))
    top = steps.where(F.col("over") <= targets.spare).agg(F.min("step")).first()[0]
    most = 2.0 ** (((0 if top is None else top) + 1) / 16)
    chance = F.round(F.least(F.lit(1.0), rate / F.lit(most)), 9)
    return stage(table.select(*[f"mix_{d}" for d in DIMENSIONS], chance.alias("mix_probability")), "mix-rates")


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def with_mixing(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """``docs`` with topic cell, mix_tokens, mix_probability and mix_kept for every row.

    Null texts count as empty; a document without tokens gets probability 1, for it weighs
    nothing. Rows of one doc_id are drawn alike; without a doc_id all are drawn as one id. An
    empty table stays empty. Columns that begin with mix_ are replaced, others are kept.
    """
    plain = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    text = F.coalesce("text", F.lit(""))
    own = plain.withColumns(
        {
            "mix_source": F.coalesce("source", F.lit("")),
            "mix_lang": F.coalesce("lang", F.lit("")),
            "mix_topic": topic_of(text),
            "mix_tokens": tokens_of(text),
        }
    )
    found = own.join(rates(placed(plain), targets), [f"mix_{d}" for d in DIMENSIONS], "left")
    found = found.withColumn("mix_probability", F.when(F.col("mix_tokens") == 0, 1.0).otherwise(F.coalesce("mix_probability", F.lit(1.0))))
    return found.withColumn("mix_kept", draw(F.col("doc_id"), targets.seed) < F.col("mix_probability"))


@keeps_columns("doc_id", "text", "lang", "source")
def mix(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """The sampled documents, with their own columns."""
    return with_mixing(docs, targets).where("mix_kept").select(docs.columns)


def oracle(targets: Targets = Targets()) -> str:
    """The same rows as ``with_mixing``'s digest columns, as DuckDB SQL."""
    topic = "'prose'"
    for name, marks in reversed(TOPICS.items()):
        held = " OR ".join(f"contains(x, '{m}')" for m in marks)
        topic = f"CASE WHEN {held} THEN '{name}' ELSE {topic} END"
    steps = [
        f"""base AS (SELECT doc_id, source, lang, coalesce(text, '') AS x FROM documents),
d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {topic} AS topic,
  CASE WHEN x = '' THEN 0 ELSE length(x) - length(replace(replace(x, ' ', ''), chr(10), '')) + 1 END AS tokens FROM base),
c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0)"""
    ]
    for k in DIMENSIONS:
        power = targets.flatten.get(k, 1.0)
        steps.append(
            f"t_{k} AS (SELECT {k}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS wish FROM c GROUP BY {k})"
        )
    steps.append("w0 AS MATERIALIZED (SELECT *, tokens / sum(tokens) OVER () AS w FROM c)")
    at = 0
    for _ in range(targets.sweeps):
        for k in DIMENSIONS:
            steps.append(
                f"w{at + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, w * wish / sum(w) OVER (PARTITION BY {k}) AS w"
                f" FROM w{at} JOIN t_{k} USING ({k}))"
            )
            at += 1
    steps.append(f"""s AS (SELECT floor(log2(w / tokens) * 16) AS step, sum(w) AS w FROM w{at} GROUP BY 1),
o AS (SELECT step, coalesce(sum(w) OVER (ORDER BY step DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over_ FROM s),
q AS (SELECT pow(2, (min(step) + 1) / 16) AS most FROM o WHERE over_ <= {targets.spare}),
r AS (SELECT source, lang, topic, round(least(1.0, w / tokens / (SELECT most FROM q)), 9) AS p FROM w{at})""")
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT doc_id, topic, tokens::BIGINT AS tokens, p AS probability,
  ('0x' || substr(md5('{targets.seed}:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 < p AS kept
FROM (SELECT d.*, CASE WHEN d.tokens = 0 THEN 1.0 ELSE coalesce(r.p, 1.0) END AS p
      FROM d LEFT JOIN r USING (source, lang, topic))"""
    )
