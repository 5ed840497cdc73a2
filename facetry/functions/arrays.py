"""Token lists, index sequences and score vectors held in array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from facetry.schema import CLASSES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code_point(hex_digits: Column) -> Column:
    """The character of a hexadecimal code point (UTF-32 alone would swallow U+FEFF as a mark)."""
    full = F.lpad(hex_digits, 8, "0")
    wide = F.decode(F.unhex(full), "UTF-32")
    plain = F.decode(F.unhex(F.right(full, F.lit(4))), "UTF-16BE")
    return F.when(full.startswith("0000"), plain).otherwise(wide)


def _unescape(item: Column) -> Column:
    """Resolve the backslash escapes of a quoted list item."""
    pieces = F.regexp_extract_all(
        item,
        F.lit(r"(?s)\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\.|[^\\]+"),
        F.lit(0),
    )

    def resolve(p: Column) -> Column:
        return (
            F.when(~p.startswith("\\"), p)
            .when(p.rlike(r"^\\[xuU][0-9a-fA-F]{2}"), _code_point(F.substr(p, F.lit(3))))
            .when(p == "\\n", F.lit("\n"))
            .when(p == "\\r", F.lit("\r"))
            .when(p == "\\t", F.lit("\t"))
            .otherwise(F.substr(p, F.lit(2)))
        )

    return F.array_join(F.transform(pieces, resolve), "")


# Code points that are no characters: they stand for separators and escapes while a whole list is rewritten.
_SEPARATOR, _BACKSLASH, _QUOTE = "\ufdd0", "\ufdd1", "\ufdd2"


def _count(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def parse_token_list(text: Column | str) -> Column:
    """Read the text of a quoted list (``['a', "b"]``) as an array, without evaluating it.

    A list as ``format_token_list`` writes it is taken apart as one text, any other one item by item.
    """
    text = _col(text)
    masked = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit("\\'"), F.lit(_QUOTE))
    for escaped, raw in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        masked = F.replace(masked, F.lit(escaped), F.lit(raw))
    inner = F.substr(masked, F.lit(3), F.length(masked) - 4)
    # every quote between the first and the last one belongs to a separator
    usual = masked.startswith("['") & masked.endswith("']") & (F.length(masked) >= 4)
    usual &= _count(inner, "'") == 2 * _count(inner, "', '")
    for mark in (_SEPARATOR, _BACKSLASH, _QUOTE):
        usual &= ~F.contains(text, F.lit(mark))
    items = F.replace(inner, F.lit("', '"), F.lit(_SEPARATOR))
    items = F.replace(F.replace(items, F.lit(_QUOTE), F.lit("'")), F.lit(_BACKSLASH), F.lit("\\"))
    usual &= ~F.contains(masked, F.lit("\\"))
    return F.when(usual, F.split(items, _SEPARATOR)).otherwise(_parse_items(text))


def _parse_items(text: Column) -> Column:
    quoted = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
    items = F.regexp_extract_all(text, F.lit(quoted), F.lit(0))

    def unquote(item: Column) -> Column:
        inner = F.substr(item, F.lit(2), F.length(item) - 2)
        return F.when(F.contains(inner, F.lit("\\")), _unescape(inner)).otherwise(inner)

    return F.transform(items, unquote)


def format_token_list(tokens: Column | str) -> Column:
    """Write an array as the text of a quoted list that ``parse_token_list`` reads back."""
    tokens = _col(tokens)

    def escape(t: Column) -> Column:
        for raw, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            t = F.replace(t, F.lit(raw), F.lit(escaped))
        return t

    # all tokens at once, unless one is null or holds the separator: then there are more separators than gaps
    joined = F.array_join(tokens, _SEPARATOR, _SEPARATOR)
    usual = _count(joined, _SEPARATOR) == F.size(tokens) - 1
    whole = F.concat(F.lit("['"), F.replace(escape(joined), F.lit(_SEPARATOR), F.lit("', '")), F.lit("']"))
    each = F.transform(tokens, lambda t: F.concat(F.lit("'"), escape(t), F.lit("'")))
    return F.when(usual, whole).otherwise(F.concat(F.lit("["), F.array_join(each, ", "), F.lit("]")))


def checked_vector(p: Column | str, size: int = len(CLASSES)) -> Column:
    """The score vector itself; an error unless it has ``size`` numbers. A null vector stays null."""
    p = _col(p)
    good = (F.size(p) == size) & F.forall(p, lambda x: x.isNotNull() & ~F.isnan(x))
    failed = F.raise_error(F.concat(F.lit("not a vector of numbers: "), p.cast("string")))
    return F.when(p.isNull() | good, p).otherwise(failed.cast("array<double>"))


def parse_score_vector(text: Column | str, size: int = len(CLASSES)) -> Column:
    """Read ``[a b c d]`` as an array of doubles; a null cell is null, any other text an error."""
    inner = F.btrim(_col(text), F.lit("[] \n"))
    parts = F.filter(F.split(inner, r"\s+"), lambda p: p != "")
    return checked_vector(F.transform(parts, lambda p: p.try_cast("double")), size)


def format_score_vector(p: Column | str) -> Column:
    return F.concat(
        F.lit("["), F.array_join(F.transform(_col(p), lambda x: x.cast("string")), " "), F.lit("]")
    )


def pad_left(seq: Column | str, maxlen: int) -> Column:
    """Keep the last ``maxlen`` entries and fill up with zeros on the left."""
    seq = F.coalesce(_col(seq), F.array().cast("array<int>"))
    size = F.size(seq)
    fill = F.array_repeat(F.lit(0), F.greatest(F.lit(maxlen) - size, F.lit(0)))
    return F.concat(fill, F.slice(seq, F.greatest(size - maxlen, F.lit(0)) + 1, F.lit(maxlen)))


def argmax_class(p: Column | str, classes: Sequence[int] = CLASSES) -> Column:
    """The class of the largest score; the first one wins a tie.

    A vector of another size, or with a null or NaN in it, is an error; a null vector has no class.
    """
    p = _col(p)
    top = F.array_max(p)
    label = F.element_at(
        F.array(*[F.lit(c) for c in classes]), F.array_position(p, top).cast("int")
    )
    good = (F.size(p) == len(classes)) & F.forall(p, lambda x: x.isNotNull() & ~F.isnan(x))
    failed = F.raise_error(F.lit(f"NaN or null in a score vector, or not {len(classes)} numbers")).cast("int")
    return F.when(p.isNotNull(), F.when(good, label).otherwise(failed))


def one_hot(y: Column | str, classes: Sequence[int] = CLASSES) -> Column:
    """One 0/1 entry per class in order; a label outside the classes is all zeros."""
    y = _col(y)
    return F.array(*[F.coalesce((y == c).cast("int"), F.lit(0)) for c in classes])
