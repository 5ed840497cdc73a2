"""Character classes, cleaning and counting on one text column.

Characters are Unicode code points and no normalisation is applied. Everything is a
built-in expression, so a cleaned scan stays one stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters every character filter drops (TAB and U+3000 are kept).
BLANKS = " \u00a0\n\ufeff\r"

# Characters removed before word segmentation, the union of two sets of symbols.
# ":-【" is a range
# (U+003A to U+3010), so ASCII letters, "=<>?@" and CJK brackets go too, while digits,
# "!", '"', "-" and Han stay.
SYMBOL_CLASS = r"\s\x1c-\x1f+./_,$%^*();；:-【】'—！，。、~#￥&（）"

# Code points shown as emoji by themselves (Unicode: emoji presentation).
EMOJI_SHOWN = (
    r"\x{231A}\x{231B}\x{23E9}-\x{23EC}\x{23F0}\x{23F3}\x{25FD}\x{25FE}\x{2614}\x{2615}"
    r"\x{2648}-\x{2653}\x{267F}\x{2693}\x{26A1}\x{26AA}\x{26AB}\x{26BD}\x{26BE}\x{26C4}\x{26C5}"
    r"\x{26CE}\x{26D4}\x{26EA}\x{26F2}\x{26F3}\x{26F5}\x{26FA}\x{26FD}\x{2705}\x{270A}\x{270B}"
    r"\x{2728}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2795}-\x{2797}\x{27B0}\x{27BF}"
    r"\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F201}"
    r"\x{1F21A}\x{1F22F}\x{1F232}-\x{1F236}\x{1F238}-\x{1F23A}\x{1F250}\x{1F251}"
    r"\x{1F300}-\x{1F320}\x{1F32D}-\x{1F335}\x{1F337}-\x{1F37C}\x{1F37E}-\x{1F393}"
    r"\x{1F3A0}-\x{1F3CA}\x{1F3CF}-\x{1F3D3}\x{1F3E0}-\x{1F3F0}\x{1F3F4}\x{1F3F8}-\x{1F43E}"
    r"\x{1F440}\x{1F442}-\x{1F4FC}\x{1F4FF}-\x{1F53D}\x{1F54B}-\x{1F54E}\x{1F550}-\x{1F567}"
    r"\x{1F57A}\x{1F595}\x{1F596}\x{1F5A4}\x{1F5FB}-\x{1F64F}\x{1F680}-\x{1F6C5}\x{1F6CC}"
    r"\x{1F6D0}-\x{1F6D2}\x{1F6D5}-\x{1F6D7}\x{1F6DC}-\x{1F6DF}\x{1F6EB}\x{1F6EC}"
    r"\x{1F6F4}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}\x{1F7F0}\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}"
    r"\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FAFF}"
)
# The other code points with the Unicode emoji property, without digits, "#" and "*".
EMOJI_TEXT = (
    r"\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}\x{21AA}\x{2328}\x{23CF}"
    r"\x{23ED}-\x{23EF}\x{23F1}\x{23F2}\x{23F8}-\x{23FA}\x{24C2}\x{25AA}\x{25AB}\x{25B6}\x{25C0}"
    r"\x{25FB}\x{25FC}\x{2600}-\x{2604}\x{260E}\x{2611}\x{2618}\x{261D}\x{2620}\x{2622}\x{2623}"
    r"\x{2626}\x{262A}\x{262E}\x{262F}\x{2638}-\x{263A}\x{2640}\x{2642}\x{265F}\x{2660}\x{2663}"
    r"\x{2665}\x{2666}\x{2668}\x{267B}\x{267E}\x{2692}\x{2694}-\x{2697}\x{2699}\x{269B}\x{269C}"
    r"\x{26A0}\x{26A7}\x{26B0}\x{26B1}\x{26C8}\x{26CF}\x{26D1}\x{26D3}\x{26E9}\x{26F0}\x{26F1}"
    r"\x{26F4}\x{26F7}-\x{26F9}\x{2702}\x{2708}\x{2709}\x{270C}\x{270D}\x{270F}\x{2712}\x{2714}"
    r"\x{2716}\x{271D}\x{2721}\x{2733}\x{2734}\x{2744}\x{2747}\x{2763}\x{2764}\x{27A1}\x{2934}"
    r"\x{2935}\x{2B05}-\x{2B07}\x{3030}\x{303D}\x{3297}\x{3299}\x{1F170}\x{1F171}\x{1F17E}\x{1F17F}"
    r"\x{1F202}\x{1F237}\x{1F321}\x{1F324}-\x{1F32C}\x{1F336}\x{1F37D}\x{1F396}\x{1F397}"
    r"\x{1F399}-\x{1F39B}\x{1F39E}\x{1F39F}\x{1F3CB}-\x{1F3CE}\x{1F3D4}-\x{1F3DF}\x{1F3F3}\x{1F3F5}"
    r"\x{1F3F7}\x{1F43F}\x{1F441}\x{1F4FD}\x{1F549}\x{1F54A}\x{1F56F}\x{1F570}\x{1F573}-\x{1F579}"
    r"\x{1F587}\x{1F58A}-\x{1F58D}\x{1F590}\x{1F5A5}\x{1F5A8}\x{1F5B1}\x{1F5B2}\x{1F5BC}"
    r"\x{1F5C2}-\x{1F5C4}\x{1F5D1}-\x{1F5D3}\x{1F5DC}-\x{1F5DE}\x{1F5E1}\x{1F5E3}\x{1F5E8}\x{1F5EF}"
    r"\x{1F5F3}\x{1F5FA}\x{1F6CB}\x{1F6CD}-\x{1F6CF}\x{1F6E0}-\x{1F6E5}\x{1F6E9}\x{1F6F0}\x{1F6F3}"
)
_UNIT = rf"[{EMOJI_SHOWN}{EMOJI_TEXT}]\x{{FE0F}}?[\x{{1F3FB}}-\x{{1F3FF}}]?"
# Every emoji but a keycap begins in one of these few ranges, which other characters are asked for first.
_FIRST = r"[\x{A9}\x{AE}\x{203C}-\x{3299}\x{1F004}-\x{1FAFF}]"
# A pair of regional letters, a keycap, a tag sequence (flags of regions), or one emoji with its
# selector, skin tone and joined followers.
EMOJI_PATTERN = (
    rf"(?:[0-9#*]\x{{FE0F}}?\x{{20E3}}|(?={_FIRST})(?:[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}"
    rf"|\x{{1F3F4}}[\x{{E0020}}-\x{{E007E}}]+\x{{E007F}}|{_UNIT}(?:\x{{200D}}{_UNIT})*))"
)

# What counts as white space at the ends of a list entry.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

# Character classes as regular-expression sets. "not_han" is not the
# complement of "han": U+4E00 and U+9FFF belong to both.
CHAR_CLASSES: dict[str, str] = {
    "han": r"[\x{4e00}-\x{9fff}]",
    "not_han": r"[^\x{4e01}-\x{9ffe}]",
    "digit": r"[0-9]",
    "letter": r"[A-Za-z]",
    "blank": r"[ \x{a0}\n\x{feff}\r]",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(text: Column | str) -> Column:
    """Trim white space of any kind at both ends, as for an entry of a line list."""
    return F.regexp_replace(_col(text), f"^{SPACE}|{SPACE}$", "")


def is_han(c: Column | str) -> Column:
    return _col(c).between("\u4e00", "\u9fff")


def not_han(c: Column | str) -> Column:
    c = _col(c)
    return (c <= "\u4e00") | (c >= "\u9fff")


def is_digit(c: Column | str) -> Column:
    return _col(c).between("0", "9")


def is_letter(c: Column | str) -> Column:
    c = _col(c)
    return c.between("A", "Z") | c.between("a", "z")


def is_blank(c: Column | str) -> Column:
    return _col(c).isin(*BLANKS)


def char_class_counts(text: Column | str) -> dict[str, Column]:
    """How many characters of a text fall into each class, without exploding the text."""
    text = _col(text)
    rest = {name: F.regexp_replace(text, f"{p}+", "") for name, p in CHAR_CLASSES.items()}
    return {name: F.length(text) - F.length(r) for name, r in rest.items()}


def stop_chars(words: Iterable[str]) -> str:
    """The entries of a stop list that can match a single character, as one string."""
    return "".join(sorted({w for w in words if len(w) == 1}))


def char_tokens(text: Column | str) -> Column:
    """Characters in order; an empty text has none."""
    text = _col(text)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def drop_stop_chars(text: Column | str, words: Iterable[str]) -> Column:
    """Remove stop characters and blanks."""
    return F.translate(_col(text), stop_chars(words) + BLANKS, "")


def spaced_chars(text: Column | str, words: Iterable[str]) -> Column:
    """The remaining characters after ``drop_stop_chars``, joined by one blank."""
    return F.array_join(char_tokens(drop_stop_chars(text, words)), " ")


def strip_symbols(text: Column | str) -> Column:
    """Remove punctuation and symbols ahead of word segmentation."""
    return F.regexp_replace(_col(text), f"[{SYMBOL_CLASS}]+", "")


def keep_han(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"[^\x{4e00}-\x{9fff}]+", "")


def keep_non_han(text: Column | str, words: Iterable[str]) -> Column:
    """Keep symbols: drop Han (bar the two boundary characters), stop characters and blanks."""
    rest = F.regexp_replace(_col(text), r"[\x{4e01}-\x{9ffe}]+", "")
    return F.translate(rest, stop_chars(words) + BLANKS, "")


def has_non_han(text: Column | str, words: Iterable[str]) -> Column:
    """Whether ``keep_non_han`` leaves anything, found at the first such character.

    Filtering on this instead of on the kept text spares computing that twice, since Spark
    evaluates a filter on a computed column ahead of the column.
    """
    dropped = "".join(f"\\x{{{ord(c):x}}}" for c in stop_chars(words) + BLANKS)
    return F.rlike(_col(text), F.lit(f"[^\\x{{4e01}}-\\x{{9ffe}}{dropped}]"))


def emojis(text: Column | str) -> Column:
    """Every emoji of a text in order, multi-code-point sequences kept whole."""
    return F.regexp_extract_all(_col(text), F.lit(EMOJI_PATTERN), F.lit(0))


def count_occurrences(text: Column | str, phrase: Column | str) -> Column:
    """Non-overlapping occurrences, counted from the left."""
    text = _col(text)
    phrase = _col(phrase) if isinstance(phrase, Column) else F.lit(phrase)
    shorter = F.length(F.replace(text, phrase, F.lit("")))
    return ((F.length(text) - shorter) / F.length(phrase)).cast("int")


def with_frequency(line: Column | str, freq: int = 2000) -> Column:
    """A user-dictionary line: the word, a blank and its frequency."""
    return F.concat_ws(" ", _col(line), F.lit(freq).cast("string"))


def without_stop_words(tokens: Column | str, words: Iterable[str]) -> Column:
    """Drop stop words from a token array, keeping order and duplicates."""
    stop = sorted(set(words))
    tokens = _col(tokens)
    return F.filter(tokens, lambda t: ~t.isin(*stop)) if stop else tokens


def lower_tokens(tokens: Column | str) -> Column:
    """Lower-case token by token, as vocabulary fitting and lookup do."""
    return F.transform(_col(tokens), F.lower)
