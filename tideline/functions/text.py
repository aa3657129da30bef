"""Markup and number extraction as Spark expressions.

Everything here stays inside the JVM: markup is cut with regular expressions, and
nesting of same-named tags is settled by folding over the pieces between them.
An element is passed around as its start tag plus content, without the end tag.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
# Possessive, so that a tag of any length is matched in a loop and not by recursion.
_ATTRS = r"""[^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+"""
_NAME_END = r"(?=[\s/>])"
_COMMENT = r"(?s)<!--.*?-->"
_RAW_ELEMENT = r"(?is)<(?:script\b.*?</script|style\b.*?</style|template\b.*?</template)\s*>"
_ANY_TAG = rf"<[!?/a-zA-Z]{_ATTRS}>"
_TEXT_OR_REFERENCE = r"(&(?:#\d+|#[xX][0-9a-fA-F]+|\w+);|[^&]+|&)"
_SPACE = "".join(chr(code) for code in range(0x10000) if chr(code).isspace())
_TO_END = 2**31 - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digits_int(text: Column) -> Column:
    """All digits of the text read as one integer, so ``'$1,250.50'`` is 125050."""
    return F.regexp_replace(text, r"[^0-9]", "").try_cast("bigint")


def number_before(text: Column, unit: str) -> Column:
    """Digits directly before ``unit``, any case: ``'1,200ft'`` gives 200."""
    return F.nullif(F.regexp_extract(text, rf"(?i)(\d+)\s*{unit}", 1), F.lit("")).cast("double")


def last_number_before(texts: Column, unit: str) -> Column:
    """Among several texts the last one with a number before ``unit`` decides."""
    numbers = F.transform(texts, lambda text: number_before(text, unit))
    return F.try_element_at(F.filter(numbers, lambda n: n.isNotNull()), F.lit(-1))


def _character(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")


def _decode_token(token: Column) -> Column:
    names = F.split(F.lit(" ".join(name2codepoint)), " ")
    codes = F.split(F.lit(" ".join(map(str, name2codepoint.values()))), " ")
    named = F.try_element_at(F.map_from_arrays(names, codes), F.regexp_extract(token, r"^&(\w+);$", 1))
    decimal = F.nullif(F.regexp_extract(token, r"^&#0*(\d{1,7});$", 1), F.lit(""))
    hexadecimal = F.nullif(F.regexp_extract(token, r"^&#[xX]0*([0-9a-fA-F]{1,6});$", 1), F.lit(""))
    return (
        F.when(~token.startswith("&"), token)
        .when(token == "&apos;", F.lit("'"))
        .otherwise(F.coalesce(_character(F.coalesce(named, decimal, F.conv(hexadecimal, 16, 10))), token))
    )


def decode_references(text: Column) -> Column:
    """Character references to characters, each read once from left to right."""
    tokens = F.regexp_extract_all(text, F.lit(_TEXT_OR_REFERENCE), F.lit(1))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, _decode_token), "")).otherwise(text)


def strip_space(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(text, F.lit(_SPACE))


def visible_markup(html: Column) -> Column:
    """Markup without comments and without script, style and template elements.

    Each leaves an empty tag behind because it separates the texts around it.
    """
    return F.regexp_replace(F.regexp_replace(html, _COMMENT, "<!>"), _RAW_ELEMENT, "<!>")


def start_tag(
    tag: str | None = None, class_: str | None = None, id_: str | None = None, has: str | None = None
) -> str:
    """Pattern of a start tag with the given name, class token, id or attribute.

    Names match in any case, values exactly.
    """
    tests = ""
    if class_:
        tests += (
            r"(?=[^>]*?\s(?i:class)\s*=\s*(?:"
            rf'"(?:[^"]*\s)?{class_}(?:\s[^"]*)?"'
            rf"|'(?:[^']*\s)?{class_}(?:\s[^']*)?'"
            rf"|{class_}(?=[\s>])))"
        )
    if id_:
        tests += rf"""(?=[^>]*?\s(?i:id)\s*=\s*(?:"{id_}"|'{id_}'|{id_}(?=[\s>])))"""
    if has:
        tests += rf"(?=[^>]*?\s(?i:{has})\s*=)"
    return rf"<(?i:{tag or '[a-z][a-z0-9]*'}){_NAME_END}{tests}{_ATTRS}>"


def attribute(markup: Column, name: str) -> Column:
    """Value of an attribute of the start tag that ``markup`` begins with; null if absent."""
    others = rf"""(?:\s++(?!{name}\s*=)[^\s=>"']++(?:\s*=\s*{_VALUE})?+)*+"""
    pattern = rf"(?is)^<\w+{others}\s+{name}\s*=\s*({_VALUE})"
    return let(
        F.regexp_extract(markup, pattern, 1),
        lambda raw: F.when(
            raw != "",
            decode_references(F.when(raw.rlike("^[\"']"), raw.substr(F.lit(2), F.length(raw) - 2)).otherwise(raw)),
        ),
    )


def _split_at_end(markup: Column, tag: Column) -> Column:
    """``struct<inside, after>`` for markup that begins with a start tag called ``tag``.

    ``inside`` ends before the matching end tag, or runs on when there is none. The first
    end tag is the matching one unless another element of that name opens before it.
    """
    end_tag = F.concat(F.lit("(?i)</"), tag, F.lit(rf"{_NAME_END}[^>]*>"))
    nested = F.concat(F.lit("(?is).<"), tag, F.lit(_NAME_END))

    def cut(halves: Column) -> Column:
        inside, after = F.element_at(halves, 1), F.coalesce(F.try_element_at(halves, F.lit(2)), F.lit(""))
        plain = F.struct(inside.alias("inside"), after.alias("after"))
        return F.when(F.rlike(inside, nested), _split_at_balanced_end(markup, tag)).otherwise(plain)

    return let(F.split(markup, end_tag, 2), cut)


def _split_at_balanced_end(markup: Column, tag: Column) -> Column:
    """As ``_split_at_end``, counting nested elements of the same name."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("end"))

    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + F.when(piece.startswith("</"), -1).otherwise(1)
        seen = acc["seen"] + 1
        return F.when(acc["end"] > 0, acc).otherwise(
            F.struct(depth.alias("depth"), seen.alias("seen"), F.when(depth == 0, seen).otherwise(0).alias("end"))
        )

    def cut(pieces: Column) -> Column:
        return let(
            F.aggregate(pieces, start, step, lambda acc: F.when(acc["end"] > 0, acc["end"]).otherwise(F.size(pieces) + 1)),
            lambda end: F.struct(
                F.array_join(F.slice(pieces, F.lit(1), end - 1), "").alias("inside"),
                F.array_join(F.slice(pieces, end, F.size(pieces)), "").alias("after"),
            ),
        )

    return let(F.split(markup, F.concat(F.lit("(?i)(?=</?"), tag, F.lit(rf"{_NAME_END})"))), cut)


def _tag_name(markup: Column, pattern: str) -> Column:
    """Name of the tag the markup begins with; a constant when the pattern says it."""
    fixed = re.match(r"<\(\?i:(\w+)\)", pattern)
    return F.lit(fixed.group(1)) if fixed else F.lower(F.regexp_extract(markup, r"^<(\w+)", 1))


def elements(markup: Column, pattern: str) -> Column:
    """All elements whose start tag matches ``pattern``, in order of appearance."""
    starts = F.filter(F.split(markup, f"(?={pattern})"), lambda piece: piece.rlike(f"^{pattern}"))
    return F.transform(starts, lambda piece: _split_at_end(piece, _tag_name(piece, pattern))["inside"])


def first_element(markup: Column, pattern: str) -> Column:
    """First element whose start tag matches ``pattern``; null when there is none."""
    return let(
        F.regexp_instr(markup, F.lit(pattern)),
        lambda at: F.when(
            at > 0,
            let(
                markup.substr(at, F.lit(_TO_END)),
                lambda rest: _split_at_end(rest, _tag_name(rest, pattern))["inside"],
            ),
        ),
    )


def without_elements(markup: Column, pattern: str) -> Column:
    """Markup with every element whose start tag matches ``pattern`` cut out."""
    kept = F.transform(
        F.split(markup, f"(?={pattern})"),
        lambda piece: F.when(
            piece.rlike(f"^{pattern}"), _split_at_end(piece, _tag_name(piece, pattern))["after"]
        ).otherwise(piece),
    )
    return F.array_join(kept, "")


def text_of(markup: Column, separator: str = "") -> Column:
    """Text between the tags, each piece trimmed, empty pieces left out."""
    pieces = F.transform(F.split(markup, _ANY_TAG), lambda piece: strip_space(decode_references(piece)))
    return F.array_join(F.filter(pieces, lambda piece: piece != ""), separator)


def raw_text_of(markup: Column) -> Column:
    """Text between the tags as it stands."""
    return decode_references(F.array_join(F.split(markup, _ANY_TAG), ""))
