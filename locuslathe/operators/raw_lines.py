"""Separating the lines that fail to parse from the good ones, which come out typed.

Structure (quoting, column count) is decided per line by Spark expressions. Values are decided per distinct value: the
distinct texts of each number column are cast once, the failing ones form a dictionary (column, text, reason), and that
joins back to the lines. A text that a third of all lines share is thus cast once, and the dictionary has it once.

The dictionary goes to all executors only while it is small, which is measured on the materialised dictionary; beyond
that it is joined by a shuffle under a salt, so that one frequent text cannot fill one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuslathe.session import cut_lineage

#: Largest dictionary, in characters of its texts, that is broadcast.
BROADCAST_CHARS = 8_000_000
#: Ways to which the lines of a frequent text are spread where the dictionary isn't broadcast.
SALTS = 64

#: What no number has: with these signs only, what casts to a double is a sign, digits with at most one point and at
#: least one digit, and an exponent.
NO_NUMBER = r"[^0-9eE.+-]"
#: Texts of a field that has no value.
MISSING = ("", ".", "NA")
_BLANKS = " \t 　"


@dataclass(frozen=True)
class LineKind:
    """The columns that lines of one kind may have, and the places (from 0) of the numbers in them."""

    columns: tuple[tuple[str, ...], ...]
    start: int = 1
    end: int = 2
    svlen: int | None = None

    @property
    def longest(self) -> tuple[str, ...]:
        return max(self.columns, key=len)


_COVERAGE = ("coverage_before_100bp", "coverage_after_100bp")
_ASM = ("chrom", "start", "end", "svtype", "info_svtype", "start_mod", "end_mod")
_LONG = ("chrom", "start", "end", "svtype", "info_svtype", "svlen", "supporting_reads", "score", "supporting_methods")
_SHORT = (
    "chrom", "start", "end", "svtype", "chr2", "pos2", "info_svtype", "svlen", "supporting_reads", "score", "RDCN",
)
_SUPPORT = ("chrom", "start", "end", "svtype", "supporting_reads")

#: The columns of the tab-separated call files by kind.
KINDS: dict[str, LineKind] = {
    "asm": LineKind((_ASM,)),
    "long": LineKind((_LONG, _LONG + _COVERAGE), svlen=5),
    "short": LineKind((_SHORT, _SHORT + _COVERAGE), svlen=7),
    "support": LineKind((_SUPPORT,)),
}

#: Column names of the typed rows: those of any kind, in the order in which the kinds first have them.
INTEGERS = ("start", "end", "start_mod", "end_mod", "svlen", "supporting_reads", "RDCN", "pos2")
DOUBLES = ("score", *_COVERAGE)


def split_fields(line: Column) -> Column:
    """struct(fields array<string> unquoted, bad boolean) of a tab-separated line.

    A field that begins with a double quote runs to its closing quote, over tabs too; a doubled quote in it stands for
    one. ``bad``: it isn't closed, or goes on after its closing quote. Quotes elsewhere are plain characters.
    """
    plain = F.split(line, "\t", -1)
    # doubled quotes are masked, so what is left closes the field; where the text has the mask's character, it is escaped
    escape, quote, own = "\u0001", "\u0001b", "\u0001a"

    def unmask(c: Column) -> Column:
        return F.replace(F.replace(c, F.lit(quote), F.lit('"')), F.lit(own), F.lit(escape))

    def step(acc: Column, token: Column) -> Column:
        opened = acc["open"].isNotNull()
        quoted = opened | token.startswith('"')
        rest = F.replace(F.when(opened, token).otherwise(F.substr(token, F.lit(2))), F.lit(escape), F.lit(own))
        rest = F.replace(rest, F.lit('""'), F.lit(quote))
        close = F.instr(rest, '"')
        closed = close > 0
        body = F.when(closed, F.substr(rest, F.lit(1), close - 1)).otherwise(rest)
        text = F.when(opened, F.concat(acc["open"], F.lit("\t"), body)).otherwise(body)
        done = F.when(quoted & ~closed, acc["fields"]).otherwise(
            F.concat(acc["fields"], F.array(F.when(quoted, unmask(text)).otherwise(token)))
        )
        return F.struct(
            done.alias("fields"),
            F.when(quoted & ~closed, text).alias("open"),
            (acc["bad"] | (quoted & closed & (close != F.length(rest)))).alias("bad"),
        )

    start = F.struct(
        F.array().cast("array<string>").alias("fields"), F.lit(None).cast("string").alias("open"), F.lit(False).alias("bad")
    )
    walked = F.aggregate(
        plain, start, step, lambda a: F.struct(a["fields"].alias("fields"), (a["bad"] | a["open"].isNotNull()).alias("bad"))
    )
    easy = F.struct(plain.alias("fields"), F.lit(False).alias("bad"))
    return F.when(line.startswith('"') | line.contains('\t"'), walked).otherwise(easy)


def _bare(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def _structure(lines: DataFrame, line_id: str, kind: str, raw: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """line_id, kind, fields, the structural reason, and the three number texts without surrounding blanks."""
    text = F.coalesce(F.regexp_replace(raw, r"\r\z", ""), F.lit(""))
    d = lines.select(
        F.col(line_id).alias("line_id"), F.col(kind).alias("kind"), split_fields(text).alias("p"), *extra
    ).select("line_id", "kind", "p.fields", "p.bad", *extra)
    widths = F.lit(False)
    for name, k in KINDS.items():
        widths = widths | ((F.col("kind") == name) & F.size("fields").isin(*(len(c) for c in k.columns)))
    reason = F.when(F.col("bad"), "bad_quoting").when(~F.coalesce(widths, F.lit(False)), "column_count")
    d = d.withColumn("structural", reason)

    def number(place) -> Column:
        value = F.lit(None).cast("string")
        for name, k in KINDS.items():
            if (at := place(k)) is not None:
                value = F.when(F.col("kind") == name, F.get("fields", F.lit(at))).otherwise(value)
        return F.when(F.col("structural").isNull(), _bare(value))

    return d.withColumns(
        {
            "v_start": number(lambda k: k.start),
            "v_end": number(lambda k: k.end),
            "v_svlen": number(lambda k: k.svlen),
        }
    ).drop("bad")


def is_number(c: Column) -> Column:
    """Whether a text is a number as the files allow it, finite as a double; null for null."""
    return F.when(c.isNotNull(), number_value(c).isNotNull())


def number_value(c: Column) -> Column:
    """The number that a text is, null for any other text."""
    d = F.when(~c.rlike(NO_NUMBER), c.try_cast("double"))
    return F.when(F.abs(d) <= F.lit(1.7976931348623157e308), d)


def invalid_values(structured: DataFrame) -> DataFrame:
    """The dictionary of failing values: (field, value, reason), each distinct text cast once."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"v_{c}").alias("value")) for c in ("start", "end", "svlen")))
    distinct = structured.select(F.inline(pairs)).where("value is not null").distinct()
    missing = (F.col("field") == "svlen") & F.col("value").isin(*MISSING)
    return distinct.where(~is_number(F.col("value")) & ~missing).select(
        "field", "value", F.concat(F.lit("invalid_"), "field").alias("reason")
    )


def judge_lines(
    lines: DataFrame,
    line_id: str = "line_id",
    kind: str = "file_kind",
    raw: str = "raw_line",
    broadcast_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """One row (line_id, kind, fields, reason) per line; ``reason`` is null for a good line.

    The first of these applies: ``bad_quoting``, ``column_count``, ``invalid_start``, ``invalid_end``,
    ``invalid_svlen``. A null line counts as an empty one (one column), a null or unknown kind has no columns that fit
    (``column_count``). Repeated lines are judged each; other columns of ``lines`` are not read. Runs one job to
    materialise the dictionary of invalid values.
    """
    d = _structure(lines, line_id, kind, raw)
    dictionary = cut_lineage(invalid_values(d))
    chars = dictionary.agg(F.coalesce(F.sum(F.length("value") + 32), F.lit(0))).head()[0]
    for field in ("start", "end", "svlen"):
        own = dictionary.where(F.col("field") == field).select(
            F.col("value").alias(f"v_{field}"), F.col("reason").alias(f"r_{field}")
        )
        if chars <= broadcast_chars:
            d = d.join(F.broadcast(own), f"v_{field}", "left")
        else:
            own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            d = d.withColumn("salt", F.pmod(F.xxhash64("line_id"), F.lit(SALTS)).cast("int"))
            d = d.join(own, [f"v_{field}", "salt"], "left").drop("salt")
    return d.select(
        "line_id", "kind", "fields", F.coalesce("structural", "r_start", "r_end", "r_svlen").alias("reason")
    )


def typed_rows(judged: DataFrame) -> DataFrame:
    """The good lines as typed rows: line_id, kind, then every column that any kind has, null where it has none.

    Numbers are cast as the files' loader does: to double, cut toward 0 for the integer columns, null where the text is
    none. ``nulled_fields`` names the number columns, joined by commas in the rows' order, whose text is neither a number
    that fits nor missing; null if there are none. Other fields are texts as they stand, unquoted.
    """
    names = list(dict.fromkeys(c for k in KINDS.values() for c in k.longest))
    numbers = [n for n in names if n in INTEGERS or n in DOUBLES]

    def text(name: str) -> Column:
        value = F.lit(None).cast("string")
        for kind, k in KINDS.items():
            if name in k.longest:
                value = F.when(F.col("kind") == kind, F.get("fields", F.lit(k.longest.index(name)))).otherwise(value)
        return _bare(value) if name in numbers else value

    def typed(name: str) -> Column:
        # the lines' own numbers were tested value by value; the others are tested here
        tested = name in ("start", "end", "svlen")
        value = F.col(f"t_{name}").try_cast("double") if tested else number_value(F.col(f"t_{name}"))
        return F.when(F.abs(value) < F.lit(9.2e18), value).cast("long") if name in INTEGERS else value

    d = judged.where("reason is null").select("line_id", "kind", *(text(n).alias(f"t_{n}") for n in names))
    d = d.select("line_id", "kind", *(f"t_{n}" for n in names), *(typed(n).alias(f"n_{n}") for n in numbers))
    lost = F.array_compact(
        F.array(*(F.when(F.col(f"n_{n}").isNull() & ~F.col(f"t_{n}").isin(*MISSING), F.lit(_renamed(n))) for n in numbers))
    )
    return d.select(
        "line_id",
        "kind",
        *(F.col(f"n_{n}" if n in numbers else f"t_{n}").alias(_renamed(n)) for n in names),
        F.when(F.size(lost) > 0, F.array_join(lost, ",")).alias("nulled_fields"),
    )


def _renamed(name: str) -> str:
    return {"start": "start_pos", "end": "end_pos"}.get(name, name.lower())


def rejected_lines(judged: DataFrame) -> DataFrame:
    """(line_id, reason) of the lines that fail."""
    return judged.where("reason is not null").select("line_id", "reason")
