"""What each of several filters removes, in every order in which they can be applied.

A document's failing filters are a bit mask. The masks, not the documents, meet
the orders: per part at most 2 to the number of filters, however many documents.
Two filters read the sparse document-term matrix (row sums and entries), the
others plain expressions and, for copies, the smallest identifier of each text.

Null text counts as empty, so null and empty texts are copies of each other. A
null identifier is smaller than none and copies none. Rows that repeat an
identifier are judged by their own texts, and are no copies of each other. Labels
that repeat an identifier count if any of them says so. A null part is the empty
string. Other columns are not read, so they may have any name. An empty table
gives no rows.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revcat.llm.common import whole_text
from revcat.llm.term_matrix import matrix, row_statistics
from revcat.session import written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT, SYMBOLS = 50, 65, 5, "[#$%&*|]"


def _measured(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, part and digest of every document, and the masks of the filters that read one text only."""
    text = whole_text(f"`{text_col}`")
    plain = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MAX_CAPITALS_PERCENT * F.length(text)).alias("c"),
        text.rlike(SYMBOLS).alias("d"),
    )
    _, shards = matrix(plain, keep=["id", "part", "digest", "c", "d"])
    fails = {
        "A": F.col("n_words") < MIN_WORDS,
        "B": 100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"),
        "C": F.col("row.c"),
        "D": F.col("row.d"),
    }
    return row_statistics(shards).select("row.id", "row.part", "row.digest", _mask(fails).alias("mask"))


def _mask(fails: dict[str, Column]) -> Column:
    bits = [F.when(failed, F.lit(1 << FILTERS.index(letter))).otherwise(F.lit(0)) for letter, failed in fails.items()]
    return sum(bits[1:], bits[0])


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the filters they fail (bit 0 is the first), and labels among them."""
    # Rows alike in all that matters are one from here on, so no key of a join below is hot.
    measured = _measured(docs, id_col, text_col, part_col)
    facts = written(measured.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("docs")), "facts")
    first = facts.groupBy("digest").agg(F.min("id").alias("id")).where("id IS NOT NULL").withColumn("is_first", F.lit(True))
    copies = F.col("id").isNotNull() & F.col("is_first").isNull()
    facts = facts.join(first, ["digest", "id"], "left").select("id", "part", "docs", (F.col("mask") + _mask({"E": copies})).alias("mask"))
    facts = facts.groupBy("id", "part", "mask").agg(F.sum("docs").alias("docs"))
    said = labels.groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    known = facts.join(said, "id", "left")
    counted = {c: F.coalesce(F.sum(F.col("docs") * F.col(c)), F.lit(0)).alias(c) for c in ("good", "toxic")}
    return known.groupBy("part", "mask").agg(F.sum("docs").alias("docs"), *counted.values())


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For each part, order of the filters and step: what the step keeps, removes, and would have removed.

    ``counted`` is as from ``masks``. The orders are n! times n rows, joined by the
    mask; ``shapley`` follows from the mask alone: among k failing filters each
    comes first in n! / k orders.
    """
    steps = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << filters.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "own": own, "before": before})
            before |= own
    # As one literal: rows given one by one would be read by Python workers, which then stay beside the executors.
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, own int, before int>>")
    steps = counted.sparkSession.range(0, 1, 1, 1).select(F.inline(listed))
    steps = steps.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))))
    own, before = (F.col("mask").bitwiseAND(F.col(c)) for c in ("own", "before"))
    failing, fresh = own != 0, before == 0

    def documents(chosen: Column, of: str = "docs") -> Column:
        return F.sum(F.when(chosen, F.col(of)).otherwise(F.lit(0)))

    share = (F.lit(factorial(len(filters))) / F.bit_count("mask")).cast("long")
    met = counted.join(F.broadcast(steps), "mask")
    return met.groupBy("part", "filter_order", "step").agg(
        documents(~failing & fresh).alias("kept"),
        documents(failing & fresh).alias("removed"),
        documents(failing & ~fresh).alias("redundant"),
        documents(F.col("mask") == F.col("own")).alias("unique_fails"),
        documents(failing & fresh, "good").alias("good_lost"),
        documents(failing & fresh, "toxic").alias("toxic_lost"),
        F.sum(F.when(failing, F.col("docs") * share).otherwise(F.lit(0))).alias("shapley"),
    )
