import re

from pyspark.sql import functions as F

from facetry.functions import text as tx

STOP = ["的", "了", "，", "a", "-", "]", "\\", "没有", ""]
BLANK = {" ", " ", "\n", "﻿", "\r"}


def run(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r[1] for r in df.select("id", column).orderBy("id").collect()]


def kept(text, keep):
    return "".join(c for c in text if keep(c))


def test_drop_stop_chars(spark, texts):
    stop = set(STOP)
    want = [kept(t, lambda c: c not in stop and c not in BLANK) for t in texts]
    assert run(spark, texts, tx.drop_stop_chars("text", STOP)) == want
    assert run(spark, texts, tx.spaced_chars("text", STOP)) == [" ".join(w) for w in want]


def test_tab_and_wide_blank_are_kept(spark):
    assert run(spark, ["\t　  \n\r﻿"], tx.drop_stop_chars("text", [])) == ["\t　"]


def test_keep_han_and_borders(spark, texts):
    want = [kept(t, lambda c: "一" <= c <= "鿿") for t in texts]
    assert run(spark, texts, tx.keep_han("text")) == want
    stop = set(STOP)
    symbols = [
        kept(t, lambda c: (c <= "一" or c >= "鿿") and c not in stop and c not in BLANK)
        for t in texts
    ]
    assert run(spark, texts, tx.keep_non_han("text", STOP)) == symbols
    assert run(spark, texts, tx.has_non_han("text", STOP)) == [s != "" for s in symbols]
    both = "一鿿"
    assert run(spark, [both], tx.keep_han("text")) == run(spark, [both], tx.keep_non_han("text", [])) == [both]


def test_char_tokens_are_code_points(spark, texts):
    assert run(spark, texts, tx.char_tokens("text")) == [list(t) for t in texts]
    assert run(spark, [None], tx.char_tokens("text")) == [None]


def test_strip_symbols_matches_the_two_runs_of_symbols(spark, texts):
    # fixed values: the two symbol runs as they are defined for this step
    two = r"[\s+./_,$%^*();；:-【】']+|[+—！，;:。、~#￥%&*（）]+"
    every = [chr(c) for c in [*range(1, 0x3100), *range(0xFF00, 0xFFEF), 0x4E00, 0x9FFF, 0x1F600]]
    assert run(spark, texts, tx.strip_symbols("text")) == [re.sub(two, "", t) for t in texts]
    assert run(spark, every, tx.strip_symbols("text")) == [re.sub(two, "", t) for t in every]


def test_the_symbol_range_takes_letters_but_not_digits(spark):
    assert run(spark, ["abcXYZ=<>?@", '019!"-好１'], tx.strip_symbols("text")) == ["", '019!"-好１']


def test_single_character_predicates(spark, texts):
    chars = sorted(set("".join(texts)))
    rules = [
        (tx.is_han, lambda c: "一" <= c <= "鿿"),
        (tx.not_han, lambda c: c <= "一" or c >= "鿿"),
        (tx.is_digit, lambda c: "0" <= c <= "9"),
        (tx.is_letter, lambda c: "A" <= c <= "Z" or "a" <= c <= "z"),
        (tx.is_blank, lambda c: c in BLANK),
    ]
    for column, rule in rules:
        assert run(spark, chars, column("text")) == [rule(c) for c in chars]


def test_char_class_counts(spark, texts):
    for name, column in tx.char_class_counts("text").items():
        pattern = {"han": "[一-鿿]", "not_han": "[^丁-鿾]", "digit": "[0-9]",
                   "letter": "[A-Za-z]", "blank": "[  \n﻿\r]"}[name]
        assert run(spark, texts, column) == [len(re.findall(pattern, t)) for t in texts]


def test_emojis_keep_sequences_whole(spark):
    found = run(
        spark,
        ["a👩🏽‍💻b❤️c", "🇨🇳🇺🇸", "1#*", "👍🏿👍", "☺⭐⌚", "👨‍👩‍👧", ""],
        tx.emojis("text"),
    )
    assert found == [
        ["👩🏽‍💻", "❤️"], ["🇨🇳", "🇺🇸"], [], ["👍🏿", "👍"], ["☺", "⭐", "⌚"], ["👨‍👩‍👧"], []
    ]


def test_emoji_are_those_with_the_emoji_property(spark):
    flag = "\U0001F3F4\U000E0067\U000E0062\U000E0065\U000E006E\U000E0067\U000E007F"
    texts = ["★ ✓ ☆ ♪ → ①", "1️⃣#⃣ *️⃣ 12", f"a{flag}b", "☎️✔", "🜁 🄰"]
    assert run(spark, texts, tx.emojis("text")) == [[], ["1️⃣", "#⃣", "*️⃣"], [flag], ["☎️", "✔"], []]


def test_count_occurrences(spark, texts):
    for phrase in ("a", "aa", "好吃", "😀"):
        assert run(spark, texts + ["aaaa"], tx.count_occurrences("text", phrase)) == [
            t.count(phrase) for t in texts + ["aaaa"]
        ]


def test_with_frequency(spark):
    assert run(spark, ["(^_^)", "火锅"], tx.with_frequency("text")) == ["(^_^) 2000", "火锅 2000"]


def test_without_stop_words_keeps_duplicates(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"],), ([],), (None,)], "t array<string>")
    out = [r[0] for r in df.select(tx.without_stop_words("t", ["b", "x"])).collect()]
    assert out == [["a", "a", "c"], [], None]


def test_lower_tokens_token_by_token(spark):
    df = spark.createDataFrame([(["A", "Σ", "É"],)], "t array<string>")
    assert df.select(tx.lower_tokens("t")).first()[0] == ["a", "σ", "é"]
    assert df.select(F.lower(F.lit("ß"))).first()[0] == "ß"


def test_every_emoji_begins_where_it_is_looked_for(spark):
    """A few ranges are asked first; they hold all first characters but those of keycaps."""
    as_python = lambda c: re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U" + m[1].rjust(8, "0"), c)
    first = re.compile(as_python(tx._FIRST))
    known = re.compile(as_python(rf"[{tx.EMOJI_SHOWN}{tx.EMOJI_TEXT}\x{{1F1E6}}-\x{{1F1FF}}]"))
    every = [chr(c) for c in range(0x110000) if known.match(chr(c))]
    assert len(every) > 1_000 and all(map(first.match, every))
    flags = set(map(chr, range(0x1F1E6, 0x1F200)))
    shown = [c for c in every if c not in flags]
    text = "7#z".join(shown) + "7\ufe0f\u20e3#\u20e3\U0001f1e8\U0001f1f3\U0001f1e8 9"
    got = spark.createDataFrame([(text,)], "text string").select(tx.emojis("text")).first()[0]
    assert got == [*shown, "7\ufe0f\u20e3", "#\u20e3", "\U0001f1e8\U0001f1f3"]
