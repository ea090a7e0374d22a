"""J3, P21. Many searches in one pass: searches are rows, not literals of a plan.

A search has no negation, so it is a list of minterms, sets of clauses that make it true together. Each event has the clauses
that it meets: those of equality by a join on field and value, those of includes by testing the distinct values. A minterm
is tried only at events that meet its rarest clause, its anchor, and holds if the event meets all of it; so an event meets
few minterms, even if a thousand searches share a frequent clause. Chunks are pruned in the same way, by a join of the
minterms' tokens with the postings. Searches are small tables that are joined with events and chunks where these lie.
"""

from __future__ import annotations

import ast
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logspark.functions.scalar import DELIMITERS, tokenize
from logspark.operators.prune import by_size
from logspark.operators.search import TEXT_FIELDS, clauses
from logspark.session import written

#: Minterms that a search may have; (a || b) && (c || d) has four.
MOST_MINTERMS = 10_000


def minterms_of(text: str) -> list[frozenset[int]]:
    """The smallest sets of clauses (by number) that make a search true."""
    _, shape = clauses(text)
    named = re.sub(r"\x00(\d+)\x00", r"c\1", shape.replace("&&", " and ").replace("||", " or "))

    def ways(node: ast.expr) -> set[frozenset[int]]:
        if isinstance(node, ast.Name):
            return {frozenset([int(node.id[1:])])}
        each = [ways(v) for v in node.values]
        if isinstance(node.op, ast.Or):
            return set().union(*each)
        out = {frozenset()}
        for other in each:
            out = {a | b for a in out for b in other}
            if len(out) > MOST_MINTERMS:
                raise ValueError(f"more than {MOST_MINTERMS} ways to make a search true")
        return out

    found = ways(ast.parse(named.strip(), mode="eval").body)
    return sorted((m for m in found if not any(o < m for o in found)), key=sorted)


def minterms(spark: SparkSession, searches: dict[int, str]) -> DataFrame:
    """minterm, query, and needs, its clauses as (field, kind, value); a row for each way to make a search true."""
    rows = []
    for q, text in searches.items():
        each = clauses(text)[0]
        rows += [(q, [(each[i].field, each[i].kind, each[i].value) for i in sorted(m)]) for m in minterms_of(text)]
    made = [(i, q, needs) for i, (q, needs) in enumerate(rows)]
    return spark.createDataFrame(made, "minterm long, query long, needs array<struct<field: string, kind: string, value: string>>")


def holding(events: DataFrame, terms: DataFrame, key: list[str]) -> DataFrame:
    """key and have, what an event meets of the fields that terms ask for, as clauses.

    A field is a key of enrichment, text (this) the event's text. Only clauses of includes are tested one by one.
    """
    each = written(terms.select(F.inline("needs")).distinct(), "clauses")
    tested = [(r.field, r.value) for r in each.where("kind = 'includes'").collect()]  # as many as the searches have
    asked = [r.field for r in each.where("kind = '=='").select("field").distinct().collect()]
    fields = F.filter(F.map_entries("enrichment"), lambda e: e["key"].isin(*asked))
    held = F.transform(fields, lambda e: F.struct(e["key"].alias("field"), F.lit("==").alias("kind"), e["value"].alias("value")))
    if texts := [f for f in TEXT_FIELDS if f in asked]:
        held = F.concat(held, F.array(*[F.struct(F.lit(f).alias("field"), F.lit("==").alias("kind"), F.col("text").alias("value")) for f in texts]))
    if tested:
        values = F.array(*[F.struct(F.lit(f).alias("field"), F.lit("includes").alias("kind"), F.lit(v).alias("value")) for f, v in tested])
        of = lambda c: F.when(c["field"].isin(*TEXT_FIELDS), F.col("text")).otherwise(F.try_element_at(F.col("enrichment"), c["field"]))
        held = F.concat(held, F.filter(values, lambda c: F.coalesce(F.contains(of(c), c["value"]), F.lit(False))))
    return events.select(*key, held.alias("have"))


def search_many(events: DataFrame, searches: dict[int, str], key: list[str], postings: DataFrame | None = None) -> DataFrame:
    """query and key of each event that a search finds, as the searches would one by one.

    An event is tested by itself: it meets the minterms of its own clauses by a join, and no row is shuffled for that.
    """
    spark = events.sparkSession
    terms = written(minterms(spark, searches), "minterms")
    if postings is not None and (chunks := prune_many(postings, terms)) is not None:
        events = events.join(by_size(written(chunks, "chunks")), ["object_id", "chunk_id"], "left_semi")
    found = holding(events, terms, key)
    clause = terms.select("minterm", "query", "needs", F.explode("needs").alias("one"))
    counts = found.select(F.explode("have").alias("one")).join(by_size(clause.select("one").distinct()), "one", "left_semi").groupBy("one").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min_by("one", F.struct(F.coalesce("n", F.lit(0)), "one"))
    anchors = clause.join(by_size(written(counts, "counts")), "one", "left").groupBy("minterm", "query", "needs").agg(rarest.alias("anchor"))
    tried = found.select(*key, "have", F.explode("have").alias("anchor")).join(by_size(written(anchors, "anchors")), "anchor")
    return tried.where(F.size(F.array_except("needs", "have")) == 0).select("query", *key).distinct()


def prune_many(postings: DataFrame, terms: DataFrame) -> DataFrame | None:
    """Chunks that hold all tokens of one minterm at least; None if a minterm has no token, as all chunks can hold it.

    Minterms of the same tokens are tested once, at the chunks that hold their rarest token, until one of them fits.
    """
    equal = F.filter("needs", lambda c: c["kind"] == "==")
    tokens = F.array_sort(F.array_distinct(F.flatten(F.transform(equal, lambda c: tokenize(c["value"], DELIMITERS)))))
    needed = written(terms.select(tokens.alias("tokens")).distinct(), "tokens")
    if not needed.where(F.size("tokens") == 0).isEmpty():
        return None
    each = needed.select("tokens", F.explode("tokens").alias("token"))
    wanted = postings.select("object_id", "chunk_id", "token").join(by_size(each.select("token").distinct()), "token", "left_semi")
    held = written(wanted.groupBy("object_id", "chunk_id").agg(F.collect_set("token").alias("have")), "held")
    counts = held.select(F.explode("have").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    anchors = each.join(by_size(written(counts, "counts")), "token", "left").groupBy("tokens").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("anchor"))
    sets = written(anchors.groupBy("anchor").agg(F.collect_list("tokens").alias("sets")), "sets")
    tried = held.select("object_id", "chunk_id", "have", F.explode("have").alias("anchor")).join(by_size(sets), "anchor")
    fits = F.exists("sets", lambda need: F.forall(need, lambda t: F.array_contains("have", t)))
    return tried.where(fits).select("object_id", "chunk_id").distinct()
