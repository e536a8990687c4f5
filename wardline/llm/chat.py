"""Chat formatting with quotations linked to the messages they come from.

Everything is DataFrame work. Each message is split into lines with a quote
level (the number of leading ``>``), and runs of lines of one level into
passages, whose line breaks count as spaces, so a passage wrapped anew stays
the same. Quoted passages are hashed and joined to the latest earlier message
that has the passage one level up (at the first level: wrote it itself), or
else to the latest that wrote it; a passage found nowhere as a whole is looked
up by its sentences, and then by its lines. A message answers the one that most words of its
outermost linked quotations come from, or else the message before it.
Conversations are then put in reply order and formatted without the quotations.

No step gathers a conversation: ranks are taken by range-partitioned tasks,
quotation lookups by stretches of ``STRETCH`` messages, and the text comes in
parts of ``PART`` messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import rank_within

MARKS = r"^[ \t]*((?:>[ \t]?)+)"  # a line's quote marks
SAID = r"(?i)\b(wrote|writes|schrieb|escribió|écrit)\b[^:]*:[ \t]*$"  # says whom a quotation is from
QUOTES = r"(?m)^[ \t]*>"  # a text that has quoted lines
SENTENCE = r"[^.!?]+[.!?]*"
STRETCH = 1024
PART = 64


def level_of(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 1)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def normalised(line: Column) -> Column:
    """A line without quote marks, in lower case, white space made one."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"[ \t\r]+", " "))


def unquoted(lines: Column) -> Column:
    """A message's own text: its lines without quotations and the lines that
    introduce them."""
    def own(x, i):
        follows = F.coalesce(level_of(F.get(lines, i + 1)) > 0, F.lit(False))
        return (level_of(x) == 0) & ~(F.regexp_like(x, F.lit(SAID)) & follows)
    return F.trim(F.array_join(F.filter(lines, own), "\n"))


def ranked_messages(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """(conv_id, conv, turn, role, text, position): position counts the
    messages of a conversation from 0 by turn, then role and text."""
    msgs = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    msgs = msgs.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    return rank_within(msgs, ["conv"], ["turn", "role", "text"], "position")


def passages(ranked: DataFrame) -> DataFrame:
    """(conv, position, level, run, lines, text): runs of lines of one quote
    level, normalised, and joined by spaces. A blank line ends a run, and so does a line
    that introduces a quotation; neither is part of one."""
    lines = F.split("text", "\n", -1)
    by_line = Window.partitionBy("conv", "position").orderBy("i")
    each = (ranked.select("conv", "position", F.posexplode(lines).alias("i", "line"))
                  .select("conv", "position", "i", level_of(F.col("line")).alias("level"),
                          F.regexp_like("line", F.lit(SAID)).alias("said"), normalised(F.col("line")).alias("line"))
                  .withColumn("line", F.when(F.col("said") & (F.lead("level").over(by_line) > F.col("level")), "")
                              .otherwise(F.col("line"))))
    new = (F.lag("level").over(by_line) != F.col("level")) | (F.lag("line").over(by_line) == "")
    runs = (each.withColumn("new", F.coalesce(new, F.lit(False)).cast("long"))
                .withColumn("run", F.sum("new").over(by_line)).where("line <> ''"))
    return (runs.groupBy("conv", "position", "level", "run")
                .agg(F.array_sort(F.collect_list(F.struct("i", "line"))).alias("ls"))
                .select("conv", "position", "level", "run", F.col("ls.line").alias("lines"), F.array_join("ls.line", " ").alias("text")))


def latest_before(sources: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """``asked`` (keys, position) with ``source``, the last position before its
    own that ``sources`` (keys, position) has; rows without one are left out.
    Rows of one key are looked through by stretches of ``STRETCH`` positions."""
    stretch = F.floor(F.col("position") / STRETCH).alias("stretch")
    # the last source in each stretch, known to all later stretches
    ends = sources.groupBy(*keys, stretch).agg(F.max("position").alias("last"))
    earlier = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = (asked.select(*keys, stretch).distinct().join(ends, [*keys, "stretch"], "full")
                   .withColumn("before", F.max("last").over(earlier)).select(*keys, "stretch", "before"))
    both = (sources.select(*keys, stretch, "position", F.col("position").alias("source"), F.lit(False).alias("asks"))
                   .unionByName(asked.select(*keys, stretch, "position", F.lit(None).cast("long").alias("source"),
                                             F.lit(True).alias("asks"))))
    within = (Window.partitionBy(*keys, "stretch").orderBy("position")
                    .rangeBetween(Window.unboundedPreceding, -1))
    return (both.withColumn("here", F.max("source").over(within)).where("asks")
                .join(before, [*keys, "stretch"], "left")
                .withColumn("source", F.coalesce("here", "before")).where("source is not null")
                .select(*keys, "position", "source"))


def quotation_links(ranked: DataFrame) -> DataFrame:
    """(conv, position, level, source, n_words): how many words quoted at a
    level by a message come from the message at position ``source``: the latest
    earlier one that has the passage at the level before (0: its own text), or
    else as its own text. Sentences stand in for a passage that has no source,
    and lines for one whose sentences have none either."""
    quoting = ranked.where(F.regexp_like("text", F.lit(QUOTES))).select("conv").distinct()
    found = passages(ranked.join(quoting, "conv", "left_semi"))
    sentences = F.filter(F.transform(F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0)), lambda x: F.trim(x)),
                         lambda x: x != "")

    def ranked_units(rank: int, units: Column) -> Column:
        return F.transform(units, lambda u: F.struct(F.lit(rank).alias("rank"), u.alias("unit")))

    parts = F.concat(ranked_units(3, F.array("text")), ranked_units(2, sentences), ranked_units(1, F.col("lines")))
    units = (found.select("conv", "position", "level", "run", F.explode(parts).alias("u"))
                  .select("conv", "position", "level", "run", "u.rank", F.xxhash64("u.unit").alias("h"),
                          F.size(F.split("u.unit", " ")).alias("words"))
                  .groupBy("conv", "position", "level", "run", "rank", "h").agg(F.sum("words").alias("words"))
                  .checkpoint())
    # as: the level that a passage is quoted at, 0 for any
    quoted = units.where("level > 0").withColumn(
        "as", F.explode(F.when(F.col("level") > 1, F.array("level", F.lit(0))).otherwise(F.array("level"))))
    offered = units.select("conv", "h", "position", F.explode(
        F.when(F.col("level") == 0, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.col("level") + 1))).alias("as"))
    keys = ["conv", "h", "as"]
    asked = quoted.select(*keys, "position").distinct()
    sources = offered.join(asked.select(*keys).distinct(), keys, "left_semi").distinct()
    run = ["conv", "position", "level", "run"]
    linked = (quoted.join(latest_before(sources, asked, keys), [*keys, "position"])
                    .groupBy(*run, "rank", "h", "words")
                    .agg(F.max_by("source", "as").alias("source"))  # the level's own source goes before any
                    .withColumn("best", F.max("rank").over(Window.partitionBy(*run)))
                    .where("rank = best"))
    return linked.groupBy("conv", "position", "level", "source").agg(F.sum("words").alias("n_words"))


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", part: int = PART) -> DataFrame:
    """Formatted conversations: conv_id, part, n_messages, n_linked (messages
    whose quotations name what they answer), turns (in order) and text, in
    parts of ``part`` messages.

    Reply order: by the place of the message answered, then by the message's
    own place, so answers to one message stand together and after it. Messages
    that are nothing but quotations keep their place in ``turns`` and add no
    text. NULL conv_ids form one conversation, NULL turns come first, a NULL
    role is empty, a NULL text is empty; repeated rows are messages of their
    own, ties go by role and text. A quotation that no earlier
    message wrote or quoted links nothing. An empty table gives no rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranked = ranked_messages(df, conv_col, turn_col, role_col, text_col)
    outermost = F.struct((-F.col("level")).alias("minus"), "n_words", "source")
    best = (quotation_links(ranked).groupBy("conv", "position").agg(F.max(outermost).alias("b"))
            .select("conv", "position", F.col("b.source").alias("answers")))
    told = (ranked.join(best, ["conv", "position"], "left")
                  .select("conv", "conv_id", "position", "turn", "role", F.col("answers").isNotNull().cast("int").alias("linked"),
                          F.coalesce("answers", F.col("position") - 1).alias("answers"),
                          unquoted(F.split("text", "\n", -1)).alias("own")))
    placed = rank_within(told, ["conv"], ["answers", "position"], "place")
    said = F.when(F.col("own") == "", "").otherwise(F.concat(F.lit("<|"), "role", F.lit("|>\n"), "own", F.lit("\n<|end|>\n")))
    one = F.struct("place", "turn", said.alias("said"))
    return (placed.withColumn("part", F.floor(F.col("place") / part))
                  .groupBy("conv", "part")
                  .agg(F.first("conv_id").alias("conv_id"), F.count("*").alias("n_messages"), F.sum("linked").alias("n_linked"),
                       F.array_sort(F.collect_list(one)).alias("m"))
                  .select("conv_id", "part", "n_messages", "n_linked",
                          F.array_join(F.transform("m.turn", lambda t: F.coalesce(t.cast("string"), F.lit("?"))), ",").alias("turns"),
                          F.array_join("m.said", "").alias("text")))


# The same in DuckDB's SQL, for the table ``conversations``.
ORACLE_SQL = r"""
WITH ranked AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS conv, CAST(turn AS BIGINT) AS turn,
         coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS position
  FROM conversations),
split AS (
  SELECT conv, position, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i FROM ranked),
lines AS (
  SELECT conv, position, i, line,
         len(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1)) - len(replace(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1), '>', '')) AS level,
         trim(regexp_replace(lower(regexp_replace(line, '^[ \t]*((?:>[ \t]?)+)', '')), '[ \t\r]+', ' ', 'g')) AS norm
  FROM split),
next AS (SELECT *, coalesce(lead(level) OVER (PARTITION BY conv, position ORDER BY i), 0) AS after FROM lines),
own AS (
  SELECT conv, position, trim(string_agg(line, chr(10) ORDER BY i)) AS own FROM next
  WHERE level = 0 AND NOT (after > 0 AND regexp_matches(line, '(?i)\b(wrote|writes|schrieb|escribió|écrit)\b[^:]*:[ \t]*$'))
  GROUP BY conv, position),
marked AS (
  SELECT conv, position, i, level, CASE WHEN after > level
         AND regexp_matches(line, '(?i)\b(wrote|writes|schrieb|escribió|écrit)\b[^:]*:[ \t]*$') THEN '' ELSE norm END AS norm FROM next),
cuts AS (
  SELECT *, CASE WHEN lag(level) OVER w <> level OR lag(norm) OVER w = '' THEN 1 ELSE 0 END AS new
  FROM marked WINDOW w AS (PARTITION BY conv, position ORDER BY i)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY conv, position ORDER BY i) AS run FROM cuts),
passages AS (
  SELECT conv, position, level, run, string_agg(norm, ' ' ORDER BY i) AS text FROM runs WHERE norm <> ''
  GROUP BY conv, position, level, run),
sentences AS (SELECT conv, position, level, run, trim(unnest(regexp_extract_all(text, '[^.!?]+[.!?]*'))) AS unit FROM passages),
units AS (
  SELECT conv, position, level, run, 3 AS rank, text AS unit, 1 AS k FROM passages
  UNION ALL
  SELECT conv, position, level, run, 2, unit, count(*) FROM sentences WHERE unit <> '' GROUP BY conv, position, level, run, unit
  UNION ALL
  SELECT conv, position, level, run, 1, norm, count(*) FROM runs WHERE norm <> '' GROUP BY conv, position, level, run, norm),
linked AS (
  SELECT q.conv, q.position, q.level, q.run, q.rank, q.k * len(string_split(q.unit, ' ')) AS words,
         coalesce(max(CASE WHEN o.level = q.level - 1 THEN o.position END), max(o.position)) AS source
  FROM units q JOIN units o ON q.conv = o.conv AND q.unit = o.unit AND o.position < q.position
  WHERE q.level > 0 AND (o.level = q.level - 1 OR o.level = 0)
  GROUP BY q.conv, q.position, q.level, q.run, q.rank, q.unit, q.k),
picked AS (SELECT * FROM linked QUALIFY rank = max(rank) OVER (PARTITION BY conv, position, level, run)),
best AS (
  SELECT conv, position, source FROM (
    SELECT conv, position, level, source, sum(words) AS n FROM picked GROUP BY conv, position, level, source)
  QUALIFY row_number() OVER (PARTITION BY conv, position ORDER BY level, n DESC, source DESC) = 1),
placed AS (
  SELECT r.*, b.source IS NOT NULL AS linked, coalesce(o.own, '') AS own,
         row_number() OVER (PARTITION BY r.conv ORDER BY coalesce(b.source, r.position - 1), r.position) - 1 AS place
  FROM ranked r LEFT JOIN best b ON r.conv = b.conv AND r.position = b.position
  LEFT JOIN own o ON r.conv = o.conv AND r.position = o.position)
SELECT any_value(conv_id) AS conv_id, place // 64 AS part, count(*) AS n_messages, CAST(sum(CAST(linked AS INT)) AS BIGINT) AS n_linked,
       string_agg(coalesce(CAST(turn AS VARCHAR), '?'), ',' ORDER BY place) AS turns,
       string_agg(CASE WHEN own = '' THEN '' ELSE '<|' || role || '|>' || chr(10) || own || chr(10) || '<|end|>' || chr(10) END, '' ORDER BY place) AS text
FROM placed GROUP BY conv, place // 64
"""
