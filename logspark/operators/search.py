"""Search: boolean expressions over fields, their terms, and the predicates around them.

The grammar is a == "v", includes(a, "v"), dotted fields, &&, || and parentheses; && binds tighter. Spark's own parser
reads the expression once its clauses are rewritten; only what Spark would accept and the grammar does not is rejected here.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logspark.functions.scalar import DELIMITERS, tokenize

CLAUSE = re.compile(r'includes\s*\(\s*([A-Za-z_][\w.]*)\s*,\s*"([^"]*)"\s*\)|([A-Za-z_][\w.]*)\s*==\s*"([^"]*)"')
TEXT_FIELDS = ("this", "text", "this.text")


@dataclass(frozen=True)
class Clause:
    """One comparison: kind is == or includes."""

    index: int
    kind: str
    field: str
    value: str


def clauses(text: str) -> tuple[list[Clause], str]:
    """The clauses in order and the expression with \\x00<index>\\x00 for each; ValueError if it isn't in the grammar."""
    if not text or not text.strip():
        raise ValueError("empty search")
    if "\x00" in text:
        raise ValueError("search holds a zero character")
    found: list[Clause] = []

    def put(m: re.Match) -> str:
        found.append(Clause(len(found), "includes", m[1], m[2]) if m[1] else Clause(len(found), "==", m[3], m[4]))
        return f"\x00{len(found) - 1}\x00"

    shape = CLAUSE.sub(put, text)
    left, before = re.sub(r"\x00\d+\x00", "c", re.sub(r"\s+", "", shape)), None
    while left != before:
        before = left
        left = re.sub(r"c(?:&&|\|\|)c", "c", left.replace("(c)", "c"))
    if left != "c":
        raise ValueError(f"not a search: {text}")
    return found, shape


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _tree(text: str, clause) -> str:
    """The expression as SQL, with clause(c) for each clause."""
    found, shape = clauses(text)
    sql = shape.replace("&&", " AND ").replace("||", " OR ")
    return re.sub(r"\x00(\d+)\x00", lambda m: f"({clause(found[int(m[1])])})", sql)


def search_expr(text: str, fields: dict[str, str] | None = None, arrays: tuple[str, ...] = ()) -> Column:
    """P1, P8. A search as a predicate; fields maps its names to SQL expressions, arrays are those of list type."""
    names = fields or {}

    def sql(c: Clause) -> str:
        at = names.get(c.field) or ".".join(f"`{p}`" for p in c.field.split("."))
        if c.field in arrays:
            return f"coalesce(array_contains({at}, {_literal(c.value)}), false)"
        return f"coalesce({at} = {_literal(c.value)}, false)" if c.kind == "==" else f"coalesce(contains({at}, {_literal(c.value)}), false)"

    return F.expr(_tree(text, sql))


def combine_filters(filters: list[str], search: str | None = None, **kw) -> Column:
    """P2. All filters and the search, each as if in parentheses."""
    parts = [*filters, *([search] if search else [])]
    if not parts:
        raise ValueError("no filter and no search")
    return reduce(lambda a, b: a & b, [search_expr(p, **kw) for p in parts])


def search_terms(spark: SparkSession, text: str) -> DataFrame:
    """P3. Constants of a search in order: idx, field, value, kind."""
    return spark.createDataFrame([(c.index, c.field, c.value, c.kind) for c in clauses(text)[0]], "idx int, field string, value string, kind string")


def route_terms(terms: DataFrame) -> DataFrame:
    """P4. Adds target: text or enrichment."""
    return terms.withColumn("target", F.when(F.col("field").isin(*TEXT_FIELDS), "text").otherwise("enrichment"))


def overlaps(min_ts, max_ts, t0: int, t1: int) -> Column:
    """P9. Whether a chunk's times meet the half-open window."""
    return (F.lit(t0) <= min_ts) & (F.lit(t1) > min_ts) if max_ts is None else (F.lit(t0) <= max_ts) & (F.lit(t1) > min_ts)


def in_range(ts: Column, t0: int, t1: int) -> Column:
    """P10. Event time in [t0, t1); 0 and 0 stand for no bounds."""
    return F.lit(True) if not t0 and not t1 else (ts >= t0) & (ts < t1)


def line_has(col: Column, term: str) -> Column:
    """P11."""
    return F.contains(col, F.lit(term))


def line_has_terms(col: Column, terms: list[str], mode: str = "all") -> Column:
    """P12. All terms, or any with mode any; without terms every line."""
    tests = [line_has(col, t) for t in terms]
    return reduce((lambda a, b: a & b) if mode == "all" else (lambda a, b: a | b), tests) if tests else F.lit(True)


def where_user(df: DataFrame, sql_text: str) -> DataFrame:
    """P13, E1. Rows for which a user's SQL predicate is true."""
    return df.where(F.expr(sql_text))


def with_outcome(df: DataFrame, sql_text: str, match: str = "accept", mismatch: str = "deny", out: str = "outcome") -> DataFrame:
    """P13. The outcome of a user's predicate for each row; a predicate that is null doesn't match."""
    return df.withColumn(out, F.when(F.coalesce(F.expr(sql_text).cast("boolean"), F.lit(False)), match).otherwise(mismatch))


def is_template_line(col: Column) -> Column:
    """P16."""
    return F.coalesce(F.get_json_object(col, "$.templateHash").isNotNull(), F.lit(False))


def is_empty_query(hashes, tokens) -> bool:
    """P17."""
    return not hashes and not any(tokens or ())


def valid_request(t0: Column, t1: Column, terms: Column) -> Column:
    """P17, P18. Whether a request has terms and a range that does not end before it starts, for tables of requests."""
    return (t0 < t1) & (F.size(F.filter(terms, lambda t: F.trim(t) != "")) > 0)


def not_stale(deadline: Column, now: Column, grace: str = "10 minutes") -> Column:
    """P19. Not past the deadline by more than the grace."""
    return now <= deadline + F.expr(f"INTERVAL {grace}")


def level_enabled(col: Column, levels: list[str] | None = None) -> Column:
    """P20. All levels but DEBUG, or those named."""
    return col.isin(*levels) if levels else col != "DEBUG"


@dataclass
class QueryOptions:
    """P18, D10. What a query asks for; times in ms."""

    search: str | None = None
    filters: list[str] = field(default_factory=list)
    t0: int = 0
    t1: int = 0
    cap: int = 2000
    max_bytes: int | None = None

    def __post_init__(self) -> None:
        if (self.t0 or self.t1) and self.t0 >= self.t1:
            raise ValueError("from must be before to")
        if self.search is not None and not self.search.strip():
            raise ValueError("blank search")
        if self.search is None and not self.filters:
            raise ValueError("no filter and no search")
        combine_filters(self.filters, self.search)

    def validate(self) -> QueryOptions:
        return self


def clause_tokens(spark: SparkSession, text: str, delims: str = DELIMITERS) -> list[list[str]]:
    """Tokens of each clause that can prune: those of ==; includes may match part of a token and gives none."""
    each = [tokenize(F.lit(c.value), delims) if c.kind == "==" else F.array().cast("array<string>") for c in clauses(text)[0]]
    return spark.sql("VALUES (0)").select(F.array(*each).alias("tokens")).head().tokens  # a local relation: no job


def gate_expr(text: str, clause: dict[int, str]) -> Column:
    """P7. The search's tree over one SQL test for each clause; a clause without a test counts as true."""
    return F.expr(_tree(text, lambda c: clause.get(c.index, "true")))
