"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust a score.

Everything is DataFrame expressions, with no shuffle: a row's spans depend on its text alone, so hot
sources or copies do not matter. Positions come from the pieces that ``split`` leaves between the matches
of the same pattern, in code points.

A pattern must scan a text of any length in linear time and without deep recursion. Repetitions are
therefore possessive, and a match starts where a run starts; both change no match, as the character that
ends a run is never part of it.

Email, IP address, card and phone number are always spans once their check passes. Further kinds need a
score: an IBAN that passes mod-97 has it, a number in the form of a US social security number only near a
word that says so.

Cases: null text counts as empty; an empty text has no spans, and the digest of an empty list. Repeated
rows get equal results. Kept columns of any name stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foulee.llm.frames import col, fresh, read

_LOCAL = r"[A-Za-z0-9._%+-]"
#: Code points on either side of a span in which context words count, up to the next match of the kind.
CONTEXT = 40
CONTEXT_BONUS = 0.3
ACCEPTED = 0.5
_BLOCK = 256


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without this cannot have a match.
    needs: str
    score: float
    context: str
    base: bool = True


KINDS = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, "ip|address|host|server"),
    # A run of digits with single separators, from its first digit to its last, of 16 to 19 digits.
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
        r"[0-9](?:[\x20-]?[0-9]){15}",
        0.7,
        "card|visa|master|credit|debit|pay",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|tel|call|mobile|fax"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
        0.9,
        "iban|bank|account|transfer",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "[0-9]{3}-[0-9]{2}-",
        0.3,
        "ssn|social security|tax id",
        base=False,
    ),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod_97(value: Column) -> Column:
    """ISO 7064 remainder of an IBAN, its first four characters last and letters as 10 to 35."""
    plain = F.replace(value, F.lit(" "))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, character: Column) -> Column:
        code = F.ascii(character)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(step(rest, c)))


def _octet(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(plain) <= 3) & (F.when(F.length(plain) <= 3, plain.cast("int")).otherwise(256) <= 255)


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _octet)
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return _mod_97(value) == 1
    return F.lit(True)


def _spans(text: Column, kind: Kind) -> Column:
    """All matches of a kind as structs of kind, start, end (exclusive), value and score."""
    pieces = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    # Pieces and matches alternate; a running position turns their lengths into offsets. It runs within
    # blocks first, so that a text with very many matches does not copy a long list for each of them.
    cells = F.arrays_zip(pieces.alias("piece"), found.alias("value"), F.slice(pieces, 2, F.size(pieces)).alias("rest"))
    entry = "array<struct<start:bigint,value:string,near:boolean>>"
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(entry).alias("out"))

    def step(state: Column, cell: Column) -> Column:
        start, value = state["at"] + F.length(cell["piece"]), cell["value"]
        before, after = F.substring(cell["piece"], -CONTEXT, CONTEXT), F.substring(cell["rest"], 1, CONTEXT)
        near = F.lower(F.concat(before, F.lit("\n"), after)).rlike(rf"\b(?:{kind.context})")
        one = F.array(F.struct(start.alias("start"), value.alias("value"), near.alias("near")))
        return F.struct(
            (start + F.coalesce(F.length(value), F.lit(0))).alias("at"),
            F.when(value.isNotNull() & _confirmed(kind.name, value), F.concat(state["out"], one))
            .otherwise(state["out"])
            .alias("out"),
        )


    def in_blocks(cells: Column) -> Column:
        last = F.ceil(F.size(cells) / _BLOCK).cast("int") - 1
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(cells, i * _BLOCK + 1, _BLOCK))
        return F.transform(blocks, lambda block: F.aggregate(block, begin, step))

    # As the element of an array the cells are made once; a lambda evaluates any other column anew for each element.
    blocks = F.element_at(F.transform(F.array(cells), in_blocks), 1)
    outer = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{entry}>").alias("out"))

    def move(state: Column, block: Column) -> Column:
        moved = F.transform(
            block["out"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), s["value"].alias("value"), s["near"].alias("near"))
        )
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

    def scored(span: Column) -> Column:
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(span["near"], CONTEXT_BONUS).otherwise(0.0))
        return F.struct(
            F.lit(kind.name).alias("kind"), span["start"].alias("start"),
            (span["start"] + F.length(span["value"])).alias("end"), span["value"].alias("value"), score.alias("score"),
        )

    spans = F.transform(F.flatten(F.aggregate(blocks, outer, move, lambda state: state["out"])), scored)
    if not kind.base:
        spans = F.filter(spans, lambda span: span["score"] >= ACCEPTED)
    empty = F.array().cast("array<struct<kind:string,start:long,end:long,value:string,score:double>>")
    return F.when(text.rlike(kind.needs), spans).otherwise(empty)


def find(docs: DataFrame, text_col: str, keep: Sequence[str], kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """Columns ``keep`` and, for each kind, an array of spans under the kind's name (with underscores added where a kept
    column has that name)."""
    text = F.coalesce(col(text_col), F.lit(""))
    return docs.select(*[col(name) for name in keep], *[_spans(text, kind).alias(fresh(keep, kind.name)) for kind in kinds])


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (an array as ``find`` has, in order and disjoint) replaced by its kind in brackets."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        out = F.concat(state["out"], between, F.lit("["), span["kind"], F.lit("]"))
        return F.struct(span["end"].alias("at"), out.alias("out"))

    return F.aggregate(
        spans, begin, step, lambda state: F.concat(state["out"], F.substr(text, (state["at"] + 1).cast("int")))
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read(spark, sf_dir, "documents"), "text", ["doc_id"])
    base = [kind.name for kind in KINDS if kind.base]
    spans = F.concat(*[kind.name for kind in KINDS])
    return found.select(
        "doc_id",
        *[F.size(name).cast("long").alias(f"n_{name}") for name in base],
        F.sha2(_joined(F.concat(*base)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
