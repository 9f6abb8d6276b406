"""Secret scans in DataFrame operations only: three patterns, and sliding-window entropy of candidate strings.

Positions come from patterns anchored where the last match ended, which return the text before each
match with it; lengths summed up are code points. A candidate's window keeps one count per character;
a step adds one and takes one away, and the sum of c * log2(c) follows. By window, as the queries ask,
the characters of a window tell its class, and what looks random and is not secret hides the windows
that touch it; else both are judged once for the whole candidate, labels and paths before a key included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the patterns of the three kinds, and the least length of what they must hold
ASSIGN_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN_BODY = r"[A-Za-z0-9+/_.=-]"
ASSIGN_MIN = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"   # a run of 18 or more; a shorter run holds no longer one
HEX = r"[0-9a-f]{16,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# least entropy of a window in bits, by the characters of the window or candidate; 20 different ones give 4.32
HEX_BITS, SINGLE_CASE_BITS, MIXED_BITS = 3.0, 3.5, 3.8
# strings that look random and are not secret
ALLOWED = (r"(?i)example|sample|dummy|placeholder|changeme|abcdefgh|12345678|(.)\1{5}"
           r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
# the same by window: what hides the windows that touch it, and what is a whole candidate
ALLOWED_PART = r"(?i:example|sample|dummy|placeholder|changeme|abcdefgh|12345678|(?<same>.)\k<same>{5,})"
ALLOWED_WHOLE = r"^(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$"
KINDS = ("assign", "access", "hex", "entropy")
MASK = "[secret]"


def _spans(text: Column, pattern: str, least: int = 0) -> Column:
    """array<start, end> of the matches of `pattern`, whose group 1 must hold `least` characters."""
    anchored = rf"\G(?s:(.*?)){pattern}"
    found = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(anchored), F.lit(i)).alias(n) for i, n in
                           ((0, "whole"), (1, "gap"), (2, "body"))))
    none = F.array().cast("array<struct<start:int,end:int>>")
    walked = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda s, m: F.struct(
            (s["at"] + F.length(m["whole"])).alias("at"),
            F.when(F.length(m["body"]) >= least, F.concat(s["out"], F.array(F.struct(
                (s["at"] + F.length(m["gap"])).alias("start"), (s["at"] + F.length(m["whole"])).alias("end"))))
            ).otherwise(s["out"]).alias("out")),
        lambda s: s["out"])
    return F.when(text.rlike(pattern if not least else pattern.replace("+)", f"{{{least},}})")), walked).otherwise(none)


def _xlogx(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(0.0)


def _random_spans(candidate: Column, codes: Column, start: Column, by_window: bool) -> Column:
    """array<start, end>: the joined windows of a candidate whose entropy reaches their class's bits.

    codes: the place of each character in ALPHABET, from 1. A window without letters has the class of a
    single case, or of its candidate if that asks less.
    """
    whole = (F.when(candidate.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), HEX_BITS)
             .when(candidate.rlike("[a-z]") & candidate.rlike("[A-Z]"), MIXED_BITS).otherwise(SINGLE_CASE_BITS))
    none = F.array().cast("array<struct<start:int,end:int>>")
    kept = {"counts": F.array_repeat(F.lit(0), len(ALPHABET) + 1), "sum": F.lit(0.0), "out": none, "whole": whole}
    if by_window:  # where the last upper-case and lower-case letters and the last characters outside each hex set stood
        kept |= {n: F.lit(-WINDOW) for n in ("upper", "lower", "not_upper_hex", "not_lower_hex")}
        kept["allowed"] = _spans(candidate, f"({ALLOWED_PART})")
    first = F.struct(*(c.alias(n) for n, c in kept.items()))

    def step(s, i):
        enter = F.get(codes, i)
        leave = F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(-1)
        counts = F.transform(s["counts"], lambda c, k: c + (k == enter).cast("int") - (k == leave).cast("int"))
        grown = F.get(s["counts"], enter)
        # the entering character first, then the leaving one, which may be the same
        lost = F.get(s["counts"], leave) + (enter == leave).cast("int")
        total = (s["sum"] + _xlogx(grown + 1) - _xlogx(grown)
                 + F.when(leave >= 0, _xlogx(lost - 1) - _xlogx(lost)).otherwise(0.0))
        after = {"counts": counts, "sum": total}
        low, high = start + i - (WINDOW - 1), start + i + 1
        least, open_ = s["whole"], F.lit(True)
        if by_window:
            upper, lower, digit = enter <= 26, enter.between(27, 52), enter.between(53, 62)
            seen = {"upper": upper, "lower": lower, "not_upper_hex": ~((enter <= 6) | digit), "not_lower_hex": ~(enter.between(27, 32) | digit)}
            after |= {n: F.when(c, i).otherwise(s[n]) for n, c in seen.items()}
            has = {n: after[n] > i - WINDOW for n in seen}
            letters = has["upper"] | has["lower"]
            least = (F.when(letters & ~(has["not_upper_hex"] & has["not_lower_hex"]), HEX_BITS)
                     .when(has["upper"] & has["lower"], MIXED_BITS).when(letters, SINGLE_CASE_BITS)
                     .otherwise(F.least(F.lit(SINGLE_CASE_BITS), s["whole"])))
            open_ = ~F.exists(s["allowed"], lambda m: (m["start"] <= i) & (m["end"] > i - (WINDOW - 1)))
        entropy = F.log2(F.lit(float(WINDOW))) - total / WINDOW
        hit = (i >= WINDOW - 1) & (entropy >= HEX_BITS) & (entropy >= least) & open_
        last = F.element_at(s["out"], -1)
        joined = F.when(F.size(s["out"]) == 0, F.array(F.struct(low.alias("start"), high.alias("end")))).when(
            last["end"] >= low, F.concat(F.slice(s["out"], 1, F.size(s["out"]) - 1), F.array(F.struct(last["start"].alias("start"), high.alias("end"))))
        ).otherwise(F.concat(s["out"], F.array(F.struct(low.alias("start"), high.alias("end")))))
        after["out"] = F.when(hit, joined).otherwise(s["out"])
        return F.struct(*(after.get(n, s[n]).alias(n) for n in kept))

    telling = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]") & ~candidate.rlike(ALLOWED_WHOLE if by_window else ALLOWED)
    return F.when(telling, F.aggregate(F.sequence(F.lit(0), F.length(candidate) - 1), first, step, lambda s: s["out"])).otherwise(none)


def spans(text: Column, by_window: bool = False) -> dict:
    """Column of array<start, end> for each kind, in code points, end exclusive."""
    found = _spans(text, f"({CANDIDATE})")
    own = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.substring(text, m["start"] + 1, m["end"] - m["start"]).alias("text")))
    coded = F.transform(own, lambda m: F.struct(
        m["start"].alias("start"), m["text"].alias("text"), F.transform(F.split(m["text"], ""), lambda c: F.instr(F.lit(ALPHABET), c)).alias("codes")))
    entropy = F.flatten(F.transform(coded, lambda m: _random_spans(m["text"], m["codes"], m["start"], by_window)))
    return {"assign": _spans(text, f"{ASSIGN_HEAD}({ASSIGN_BODY}+)", ASSIGN_MIN), "access": _spans(text, f"({ACCESS})"),
            "hex": _spans(text, f"({HEX})"), "entropy": entropy}


def _listed(kinds) -> Column:
    """The spans of some kinds as kind:start:end, by start and then by kind as listed."""
    def tagged(kind):
        number = F.lit(KINDS.index(kind))
        return F.transform(F.col(kind), lambda m: F.struct(m["start"].alias("start"), number.alias("kind"), m["end"].alias("end")))

    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(F.concat(*map(tagged, kinds))), lambda m: F.concat_ws(
        ":", F.get(names, m["kind"]), m["start"].cast("string"), m["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_window: bool = False) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy) for every row of docs.

    Null texts are empty; texts without a finding have empty spans; null ids and repeated rows stay; other
    columns are ignored; an empty table gives an empty one.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = src.select("doc_id", *(c.alias(k) for k, c in spans(F.col("text"), by_window).items()))
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]), F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"), F.size("entropy").cast("long").alias("n_entropy"))


def masked(text: Column, by_window: bool = False) -> Column:
    """The text with every finding, overlapping ones together, replaced by MASK; a null text stays null."""
    every = F.array_sort(F.concat(*spans(text, by_window).values()))
    walked = F.aggregate(
        every, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, m: F.when(m["start"] >= s["at"], F.struct(m["end"].alias("at"), F.concat(
            s["out"], F.substring(text, s["at"] + 1, m["start"] - s["at"]), F.lit(MASK)).alias("out"))
        ).otherwise(F.struct(F.greatest(s["at"], m["end"]).alias("at"), s["out"].alias("out"))),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(every) > 0, walked).otherwise(text)
