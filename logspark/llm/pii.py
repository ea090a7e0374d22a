"""Personal data by candidate gradient boosting, in DataFrame functions only.

1. Generators propose candidates with high recall, which may overlap: e-mail addresses also as written out ("name (at)
   site (dot) org"), four dotted numbers of any size, 13 to 19 digits with or without a right check digit, any grouped
   number as a phone, and numbers formed like social security and bank account numbers. Their places come from the
   pieces between the matches, so offsets are code points.
2. Each candidate gets yes/no features of its format and of the words around it; they form a bit pattern. No feature
   looks at what the kind's check tests (check digits, octets, number ranges, a phone's plus, the @ of an address).
3. Training: Spark counts candidates by (kind, pattern, label, fold) over all rows: at most 2^14 patterns of a kind,
   however large the corpus. The label is the check the features can't see, so trees learn which formats and contexts
   personal data has. Boosted trees of depth two are fitted on three folds of four. On the fourth, held-out, one their
   scores are calibrated (isotonic), and a kind's threshold is the least score that still means a probability of
   PRECISION or more. Folds follow from a candidate's text and context, so copies are never in both parts.
4. The trees become one SQL expression, which alone selects: candidates over the threshold are redacted whether or not
   their check holds (a card number with a mistyped digit), others are not, but for the base spans, which always stay.

Edge cases: a null or empty text has no span (empty strings and zero counts) and stays null or empty when redacted;
spans of different kinds may overlap and are redacted as one; equal rows give equal results; an empty table, or a kind
without held-out positives, trains nothing and selects nothing; an empty table gives an empty result. Other columns are
ignored, and kept by redact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds. Each pattern is the contract's, with possessive repeats where giving back can't help and
# with a look behind that skips starts which must fail, so that long runs cost linear time.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
#: Further generators of the method.
WRITTEN = r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?[(\[] ?at ?[)\]] ?[a-z0-9-]++(?:(?:\.| ?[(\[] ?dot ?[)\]] ?)[a-z0-9-]++)++"
NUMBER = r"(?<![A-Za-z0-9.+(-])\+?\(?[0-9]++(?:[ ().-]{1,3}[0-9]++)*+"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "written": WRITTEN, "number": NUMBER, "ssn": SSN, "iban": IBAN}
#: What a text must hold for a kind's pattern to be tried at all.
GATE = {"email": "@", "phone": r"\+", "written": r"(?i)[(\[] ?at ?[)\]]"}
#: Generators that belong to another kind's model and are told as that kind.
TOLD = {"written": "email", "number": "phone"}
#: Generators whose candidates train and are scored; a number is a phone's positive example with its plus.
PROPOSED = ("email", "ip", "card", "written", "number", "ssn", "iban")
MODELS = ("email", "ip", "card", "phone", "ssn", "iban")
NAMED = {
    "email": r"(?i)(?:e-?mail|mail|contact|write to|from)\W*$",
    "ip": r"(?i)(?:\bip|address|host|server|login|client)\W*(?:address|no|from)?\W*$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit)\W*(?:no|number|is)?\W*$",
    "phone": r"(?i)(?:phone|tel|telephone|call|mobile|cell|fax|contact)\W*(?:no|number|us|me|at)?\W*$",
    "ssn": r"(?i)(?:ssn|social security|security number|tax id)\W*(?:no|number|is)?\W*$",
    "iban": r"(?i)(?:iban|account|bank|transfer)\W*(?:no|number|is|to)?\W*$",
}
CONTEXT = 24
ROUNDS, RATE, PRECISION, FOLDS = 12, 0.5, 0.85, 4
SHARE_BLOCK = 256


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.split(F.reverse(digits), "")
    value = lambda d, i: F.when(i % 2 == 0, F.coalesce(d.try_cast("int"), F.lit(0))).otherwise((F.coalesce(d.try_cast("int"), F.lit(0)) * 2 / 10).cast("int") + F.coalesce(d.try_cast("int"), F.lit(0)) * 2 % 10)
    return F.aggregate(F.transform(each, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    """The kind's own check of a candidate's text."""
    n = F.length(_digits(found))
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.right(F.concat(F.lit("000"), p), F.lit(3)).try_cast("int"), F.lit(999)) <= 255))
    if kind == "card":
        return n.between(13, 19) & luhn(_digits(found))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "ssn":
        return found.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    if kind == "iban":
        moved = F.regexp_replace(found, " ", "")
        letters = F.transform(F.split(F.concat(F.substring(moved, 5, 64), F.left(moved, F.lit(4))), ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))
        left = F.aggregate(F.split(F.array_join(letters, ""), ""), F.lit(0), lambda a, d: (a * 10 + F.coalesce(d.try_cast("int"), F.lit(0))) % 97)
        return left == 1
    if kind == "number":
        return found.startswith("+") & n.between(9, 15)
    return F.lit(kind != "written")


def _ends(lengths: Column) -> Column:
    """Running sums of an array of lengths, by blocks: no step looks at more than a block and the blocks' sums."""
    within = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(lengths) / SHARE_BLOCK).cast("int")), lambda b: within(F.slice(lengths, b * SHARE_BLOCK + 1, F.lit(SHARE_BLOCK))))
    before = F.transform(blocks, lambda _, b: within(F.slice(blocks, F.lit(1), b)))
    return F.transform(lengths, lambda _, i: F.get(before, (i / SHARE_BLOCK).cast("int")) + within(F.slice(lengths, ((i / SHARE_BLOCK).cast("int") * SHARE_BLOCK + 1), i % SHARE_BLOCK + 1)))


def _once(value: Column, body) -> Column:
    """body(value) with value evaluated once: a lambda variable stands for it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def candidates(text: Column, kind: str) -> Column:
    """Array of (start, end, found, before, after) of a kind's matches; before and after are up to CONTEXT characters around."""
    pattern = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr("cast(array() as array<struct<start: int, end: int, found: string, before: string, after: string>>)")

    def placed(found_: Column) -> Column:
        def by(pieces: Column) -> Column:
            lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found_)), found_, lambda p, m: F.length(p) + F.length(m))
            around = F.zip_with(F.slice(pieces, F.lit(1), F.size(found_)), F.slice(pieces, F.lit(2), F.size(found_)), lambda p, q: F.struct(F.right(F.coalesce(p, F.lit("")), F.lit(CONTEXT)).alias("before"), F.left(F.coalesce(q, F.lit("")), F.lit(CONTEXT)).alias("after")))
            return _once(lengths, lambda ls: _once(_ends(ls), lambda ends: F.zip_with(
                F.zip_with(ends, found_, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("found"))),
                around, lambda s, p: F.struct(s["start"], s["end"], s["found"], p["before"].alias("before"), p["after"].alias("after")),
            )))

        return F.when(F.size(found_) > 0, _once(F.split(text, pattern, -1), by)).otherwise(none)

    made = _once(found, placed)
    return F.when(text.rlike(GATE[kind]), made).otherwise(none) if kind in GATE else made


def _of(kind: str, f):
    """f for one kind; Spark counts a lambda's parameters, so the kind can't be a default value."""
    return lambda s: f(kind, s)


#: Features in the order of their bits; none tests what a kind's check tests.
FEATURES = {
    "lead_4": lambda c, k: c["found"].rlike(r"^[^0-9]*4(?:[ -]?[0-9]){12}"),
    "lead_2356": lambda c, k: c["found"].rlike(r"^[^0-9]*[2356](?:[ -]?[0-9]){12}"),
    "lead_0": lambda c, k: c["found"].rlike(r"^[^0-9]*0"),
    "separated": lambda c, k: c["found"].rlike(r"[0-9][ -]+[0-9]"),
    "bracketed": lambda c, k: F.contains(c["found"], F.lit("(")) & c["found"].rlike(r"\([0-9]"),
    "sixteen": lambda c, k: F.length(_digits(c["found"])) >= 16,
    "ten": lambda c, k: F.length(_digits(c["found"])) >= 10,
    "lettered": lambda c, k: c["found"].rlike("[A-Za-z]"),
    "dotted": lambda c, k: c["found"].rlike(r"\.[^.]+\."),
    "domain": lambda c, k: c["found"].rlike(r"(?:\.|dot ?[)\]] ?)[A-Za-z]{2,6}$"),
    "after_number": lambda c, k: c["before"].rlike(r"[0-9][^A-Za-z]{0,3}$"),
    "after_sign": lambda c, k: c["before"].rlike(r"[:=#|]\s*$"),
    "named": lambda c, k: c["before"].rlike(NAMED[k]),
    "before_word": lambda c, k: c["after"].rlike(r"^[^0-9]{0,2}[A-Za-z]"),
}


def pattern_bits(c: Column, model: str) -> Column:
    bits = [F.when(f(c, model), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(FEATURES.values())]
    return sum(bits[1:], bits[0])


def model_of(kind: str) -> str:
    return TOLD.get(kind, kind)


def with_candidates(df: DataFrame, kinds: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id and, for each kind, its candidates, those of numbers with 7 to 15 digits; with keep, the row and text as well."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")] if keep else []
    one = df.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("_text"), *row)
    made = {k: candidates(F.col("_text"), k) for k in kinds}
    if "number" in made:
        made["number"] = F.filter(made["number"], lambda s: F.length(_digits(s["found"])).between(7, 15))
    held = ["doc_id", *(["_row", "_text"] if keep else [])]
    # The generator keeps later filters and projections from repeating these expressions.
    return one.select(*held, F.explode(F.array(F.struct(*[c.alias(k) for k, c in made.items()]))).alias("_c")).select(*held, "_c.*")


Tree = tuple[int, tuple[int, float, float], tuple[int, float, float]]
Model = tuple[float, list[Tree], float]


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, Model]:
    """For each kind: base score, trees (bit, then bit and leaves for its two values), threshold (infinite: selects none)."""
    rows = with_candidates(df, PROPOSED, id_col, text_col)
    facts = [F.transform(F.col(k), _of(k, lambda k, s: F.struct(
        F.lit(model_of(k)).alias("kind"), pattern_bits(s, model_of(k)).alias("bits"), valid(k, s["found"]).alias("label"), F.pmod(F.xxhash64(s["found"], s["before"]), F.lit(FOLDS)).alias("fold"),
    ))) for k in PROPOSED]
    held = F.col("f.fold") == 0
    counts = rows.select(F.explode(F.concat(*facts)).alias("f")).groupBy("f.kind", "f.bits", "f.label", held.alias("held")).agg(F.count(F.lit(1)).alias("n")).collect()
    of = lambda k, held: [(r.bits, int(r.label), r.n) for r in counts if r.kind == k and r.held == held]
    return {k: fit(of(k, False), of(k, True)) for k in MODELS}


def fit(learn: list[tuple[int, int, int]], held: list[tuple[int, int, int]]) -> Model:
    """The model of (bits, label, n) counts, with its threshold from the held-out ones."""
    start, trees = boost(learn)
    return start, trees, threshold([(score_of(b, start, trees), y, n) for b, y, n in held])


def boost(counts: list[tuple[int, int, int]]) -> tuple[float, list[Tree]]:
    """Gradient boosting of trees of depth two, logistic loss, Newton leaves with a ridge of one."""
    total, positive = sum(n for *_, n in counts), sum(n * y for _, y, n in counts)
    if not positive:
        return -math.inf, []
    start, size = math.log((positive + 1) / (total - positive + 1)), len(FEATURES)
    score = {b: start for b, *_ in counts}
    trees: list[Tree] = []
    for _ in range(ROUNDS):
        slope: dict[int, list[float]] = {b: [0.0, 0.0] for b in score}
        for b, y, n in counts:
            p = 1 / (1 + math.exp(-score[b]))
            slope[b][0] += n * (y - p)
            slope[b][1] += n * p * (1 - p)
        best = None
        for root in range(size):
            sums = [[[[0.0, 1.0], [0.0, 1.0]] for _ in range(size)] for _ in range(2)]  # side, bit, value: gradient and curvature
            for b, (g, h) in slope.items():
                for bit, cell in enumerate(sums[b >> root & 1]):
                    cell[b >> bit & 1][0] += g
                    cell[b >> bit & 1][1] += h
            gain, chosen = 0.0, []
            for side in sums:
                worth = [sum(g * g / h for g, h in cell) for cell in side]
                bit = max(range(size), key=lambda i: (round(worth[i], 9), -i))
                gain += worth[bit]
                chosen.append((bit, *(RATE * g / h for g, h in side[bit])))
            if best is None or gain > best[0] + 1e-9:
                best = gain, (root, *chosen)
        trees.append(best[1])
        score = {b: s + leaf(best[1], b) for b, s in score.items()}
    return start, trees


def leaf(tree: Tree, bits: int) -> float:
    bit, unset, set_ = tree[1 + (bits >> tree[0] & 1)]
    return set_ if bits >> bit & 1 else unset


def score_of(bits: int, start: float, trees: list[Tree]) -> float:
    return start + sum(leaf(t, bits) for t in trees)


def threshold(held: list[tuple[float, int, int]]) -> float:
    """The least score whose calibrated probability, isotonic over held-out (score, label, n), reaches PRECISION."""
    blocks: list[list[float]] = []  # least score, positives, all; probabilities rise from block to block
    sums: dict[float, list[int]] = {}
    for s, y, n in held:
        cell = sums.setdefault(round(s, 9), [0, 0])
        cell[0] += n * y
        cell[1] += n
    for s in sorted(sums):
        blocks.append([s, *sums[s]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, y, n = blocks.pop()
            blocks[-1][1] += y
            blocks[-1][2] += n
    # Laplace's rule: a block of few candidates proves little.
    return next((s - 1e-6 for s, y, n in blocks if math.isfinite(s) and y + 1 >= PRECISION * (n + 2)), math.inf)


def scored(c: Column, model: str, start: float, trees: list[Tree]) -> Column:
    """The model's score of a candidate, as an expression."""

    def total(bits: Column) -> Column:
        on = lambda bit: bits.bitwiseAND(F.lit(1 << bit)) != 0
        side = lambda s: F.when(on(s[0]), F.lit(s[2])).otherwise(F.lit(s[1]))
        return sum((F.when(on(t[0]), side(t[2])).otherwise(side(t[1])) for t in trees), F.lit(start))

    return _once(pattern_bits(c, model), total)


def _spans(df: DataFrame, id_col: str, text_col: str, keep: bool = False) -> tuple[DataFrame, list[Column], list[Column], list[Column]]:
    """Rows with candidates; for each base kind its spans; spans that the trees add; all that they select; as (kind, start, end)."""
    models = train(df, id_col, text_col)
    use = [k for k in PROPOSED if models[model_of(k)][2] < math.inf]
    rows = with_candidates(df, tuple(dict.fromkeys((*BASE, *use))), id_col, text_col, keep)
    told = lambda k, a: F.transform(a, lambda s: F.struct(F.lit(model_of(k)).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    selects = lambda k, s: scored(s, model_of(k), *models[model_of(k)][:2]) >= models[model_of(k)][2]
    own = lambda k: F.filter(F.col(k), _of(k, lambda k, s: valid(k, s["found"])))
    base = [told(k, own(k)) for k in BASE]
    # A valid candidate of these is the kind's base span, or lies in it.
    new = lambda k, s: selects(k, s) if k in ("ssn", "iban") else ~valid(k, s["found"]) & selects(k, s)
    more = [told(k, F.filter(F.col(k), _of(k, new))) for k in use]
    chosen = [told(k, F.filter(F.col(k), _of(k, selects))) for k in use]
    return rows, base, more, chosen


def _text(spans: list[Column]) -> Column:
    return F.array_join(F.transform(F.concat(*spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",") if spans else F.lit("")


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: counts of the base kinds, digest of their spans, all spans as kind:start:end, and those the trees select."""
    rows, base, more, chosen = _spans(df, id_col, text_col)
    return rows.select(
        "doc_id", *[F.size(s).cast("long").alias(f"n_{k}") for k, s in zip(BASE, base, strict=True)],
        F.sha2(_text(base), 256).alias("base_sha256"),
        _text([*base, *more]).alias("spans"),
        _text(chosen).alias("selected"),
    )


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[PII]") -> DataFrame:
    """df with the base spans, and what the trees select, replaced by mark; spans that meet by one. All columns are kept."""
    rows, base, more, _ = _spans(df, id_col, text_col, keep=True)
    order = F.sort_array(F.transform(F.concat(*base, *more), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    none = F.expr("cast(array() as array<struct<start: int, end: int>>)")

    def join(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        met = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (s["start"] < F.get(done, F.size(done) - 1)["end"]), met).otherwise(F.concat(done, F.array(s)))

    merged = F.aggregate(order, none, join)

    def cut(spans: Column) -> Column:
        before = F.transform(spans, lambda s, i: F.concat(F.substring(F.col("_text"), F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))), F.lit(mark)))
        rest = F.substring(F.col("_text"), F.coalesce(F.get(spans, F.size(spans) - 1)["end"], F.lit(0)) + 1, F.length("_text"))
        return F.concat(F.array_join(before, ""), rest)

    text = F.when(F.col(f"_row.`{text_col}`").isNotNull(), F.when(F.size(order) == 0, F.col("_text")).otherwise(_once(merged, cut)))
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
