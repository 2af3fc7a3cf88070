"""Quotation linking: which message a message answers, from what it quotes.

A line's quote level is the number of ``>`` it starts with (blanks between them
allowed). Consecutive lines of one level are a passage; passages are normalised
(A-Z in lower case, runs of white space as one blank, trimmed) and hashed, and so
are the own passages of each message, whole, by paragraph and by line. A quoted passage
belongs to the earliest message of its conversation that holds it, if that is
earlier than the quoting one. Where none holds it whole, its lines are looked up,
each by itself and by its paragraph, and it belongs to the earlier message that holds
the most of its lines, if that is more than half of them (the earliest of equals):
people cut what they quote. A message answers the message of the passages at
its lowest quote level, the latest of these; passages of deeper levels are links
too. What is left of the text without its quotes is the body.

Order: every message has the root of its thread and its depth in it, found by
pointer doubling over the links alone; sorting by (conv_id, root_turn, depth, turn)
gives the reply order, and no window or list ever holds a conversation.

A null text is empty; a message with a null conversation or turn links with
nothing. Messages that repeat a turn are separate rows; a quote of either links to
the turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revcat.llm.common import bind, fold, whole_text
from revcat.session import written

_MARKS = r"^((?:[ \t]*>)+)"
_PARAGRAPHS = r"\n[ \t]*\n"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(fold(text), r"[\s]+", " "))


def _digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _runs(lines: Column) -> Column:
    """Consecutive lines (level, text) of one level as (level, text)."""

    def of(line: Column) -> Column:
        own = F.get(line, 0)

        def starts(at: Column) -> Column:
            after = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(own)))

            def run(a: Column, b: Column) -> Column:
                part = F.slice(own, a + 1, b - a)
                return F.struct(F.get(part, 0)["level"].alias("level"), F.array_join(F.transform(part, lambda x: x["text"]), "\n").alias("text"))

            return F.zip_with(at, after, run)

        places = F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: (i == 0) | (F.get(own, i)["level"] != F.get(own, i - 1)["level"]))
        return F.get(F.transform(F.array(places), starts), 0)

    # Each step is bound by an array of one element, so that it is computed once.
    return F.get(F.transform(F.array(F.array(lines)), of), 0)


def passages(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """``messages`` with ``runs_``: their passages (level, text) in order; level 0 is the message's own text."""

    def line(text: Column) -> Column:
        marks = F.regexp_extract(text, _MARKS, 1)
        return F.struct(
            F.regexp_count(marks, F.lit(">")).alias("level"), F.regexp_replace(text, _MARKS + r"[ \t]?", "").alias("text")
        )

    lines = F.transform(F.split(whole_text(text_col), "\r?\n"), line)
    return bind(bind(messages, lines_=lines), runs_=_runs(F.col("lines_"))).drop("lines_")


def link(messages: DataFrame) -> DataFrame:
    """One row per message (conv_id, turn, role, text): its columns, body, n_quotes, reply_to, root_turn, depth."""
    parsed = passages(messages.select("conv_id", "turn", "role", "text"))
    own = F.filter("runs_", lambda r: r["level"] == 0)
    body = F.array_join(F.transform(own, lambda r: r["text"]), "\n")
    quoted = F.filter("runs_", lambda r: r["level"] > 0)
    parsed = bind(parsed.withColumn("own_", own).withColumn("quoted_", quoted), body=F.trim(body)).drop("runs_")

    quotes = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.explode("quoted_").alias("q"))
    quotes = quotes.where(normalised(F.col("q.text")) != "").select(
        "conv_id", "turn", F.col("q.level").alias("level"), _digest(F.col("q.text")).alias("digest"),
        F.sha2("q.text", 256).alias("run"), F.col("q.text").alias("text"),
    )
    quotes = written(quotes, "quotes")

    # Only conversations in which something is quoted need their passages hashed.
    quoting = quotes.select("conv_id").distinct()
    texts = parsed.join(quoting, "conv_id", "left_semi").select("conv_id", "turn", F.explode("own_").alias("o"))
    pieces = F.concat(F.array("o.text"), F.split("o.text", _PARAGRAPHS), F.split("o.text", r"\n"))
    texts = texts.select("conv_id", "turn", F.explode(F.array_distinct(pieces)).alias("piece"))
    holders = texts.select("conv_id", _digest(F.col("piece")).alias("digest"), F.col("turn").alias("original")).distinct()
    holders = written(holders, "passages")
    originals = holders.groupBy("conv_id", "digest").agg(F.min("original").alias("original"))
    whole = quotes.join(originals, ["conv_id", "digest"]).where("original < turn").select("conv_id", "turn", "level", "run", "original")
    rest = quotes.join(whole, ["conv_id", "turn", "run"], "left_anti")
    found = whole.unionByName(_mostly_held(rest, holders))
    lowest = found.groupBy("conv_id", "turn", "level").agg(F.max("original").alias("reply_to"))
    answers = lowest.groupBy("conv_id", "turn").agg(F.min(F.struct("level", "reply_to"))["reply_to"].alias("reply_to"))
    answers = written(answers, "answers")

    out = parsed.join(_threads(answers), ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "text", "body", F.size("quoted_").alias("n_quotes"), "reply_to",
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
    )


def _mostly_held(quotes: DataFrame, holders: DataFrame) -> DataFrame:
    """(conv_id, turn, level, run, original): the earlier message that holds the most lines of a quoted run, if more than half.

    A message that holds more than half of the lines holds one of any half of them, so only
    the rarer half is looked up to find messages; all lines are then counted in these. Equal
    runs of a conversation are looked up once.
    """
    of_run = ["conv_id", "run"]
    runs = quotes.groupBy(*of_run).agg(F.first("text").alias("text"), F.max("turn").alias("last"))
    lines = runs.select(*of_run, "last", F.posexplode(F.split("text", _PARAGRAPHS)).alias("paragraph", "text"))
    lines = lines.select(*of_run, "last", "paragraph", F.col("text").alias("around"), F.posexplode(F.split("text", r"\n")).alias("line", "text"))
    lines = lines.where(normalised(F.col("text")) != "").withColumn("line", F.struct("paragraph", "line"))
    either = F.array_distinct(F.array(_digest(F.col("text")), _digest(F.col("around"))))
    lines = lines.select(*of_run, "last", "line", F.explode(either).alias("digest"))
    counts = holders.groupBy("conv_id", "digest").agg(F.count("*").alias("many"))
    lines = lines.join(counts, ["conv_id", "digest"], "left")
    many = F.sum(F.coalesce("many", F.lit(0))).over(Window.partitionBy(*of_run, "line"))
    lines = lines.withColumn("many", many).withColumn("place", F.dense_rank().over(Window.partitionBy(*of_run).orderBy("many", "line")))
    lines = written(lines.withColumn("n_lines", F.max("place").over(Window.partitionBy(*of_run))), "quoted-lines")

    rare = lines.where("2 * place <= n_lines + 1").join(holders, ["conv_id", "digest"]).where("original < last")
    found = rare.select(*of_run, "original").distinct().join(lines, of_run).join(holders, ["conv_id", "digest", "original"])
    found = found.groupBy(*of_run, "original").agg(F.countDistinct("line").alias("held"), F.max("n_lines").alias("n_lines"))
    # Of each run only the messages that hold more of it than any earlier one: no more than it has lines.
    earlier = Window.partitionBy(*of_run).orderBy("original").rowsBetween(Window.unboundedPreceding, -1)
    best = found.where("2 * held > n_lines").withColumn("before", F.max("held").over(earlier)).where("before IS NULL OR held > before")
    found = quotes.join(best.select(*of_run, "original", "held"), of_run).where("original < turn")
    return found.groupBy("conv_id", "turn", "level", "run").agg(F.max_by("original", "held").alias("original"))


def _threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, root_turn, depth): each round doubles how far up a message looks."""
    now = answers.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("root_turn"), F.lit(1).cast("long").alias("depth"))
    while True:
        above = now.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("higher"), F.col("depth").alias("more"))
        joined = written(now.join(above, ["conv_id", "root_turn"], "left"), "threads")
        now = joined.select(
            "conv_id", "turn", "reply_to", F.coalesce("higher", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )
        if joined.where("higher IS NOT NULL").isEmpty():
            return now
