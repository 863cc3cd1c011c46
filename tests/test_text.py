"""C1-C6, E1-E3 on the edge-case literals of FIXTURES.md section E."""

from pyspark.sql import functions as F

from corpusforge.functions import text as tx


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def test_whitespace_is_python_s(spark):
    vals = ["a\u00a0b", "a\u001cb", "a\u2028b", "  x \t\n y  ", None, ""]
    assert run(spark, tx.collapse_whitespace, vals) == ["a b", "a b", "a b", "x y", None, ""]


def test_zero_width_after_whitespace_leaves_two_blanks(spark):
    assert run(spark, lambda c: tx.remove_zero_width(tx.collapse_whitespace(c)), ["a \u200b b"]) == ["a  b"]


def test_mojibake_and_quotes_order(spark):
    vals = ["it\u00e2\u20ac\u2122s", "\u00e2\u20ac\u0153q\u00e2\u20ac", "caf\u00c3\u00a9", "don\u2019t",
            "it's", "a`b\u00b4c"]
    got = run(spark, lambda c: tx.clean_text(c), vals)
    # apostrophes become double quotes; curly quotes are left alone
    assert got == ['it"s', '"q"', "caf\u00e9", "don\u2019t", 'it"s', 'a"b"c']


def test_nfkc_before_mojibake_quirk(spark):
    # NFKC turns U+2122 into "TM", so the mojibake sequence is no longer repaired
    got = run(spark, lambda c: tx.clean_text(c, unicode_normalize=True),
              ["\u00e2\u20ac\u2122", "\ufb01", "x\u00b4"])
    assert got[0] == "\"TM"  # ... and the shorter mojibake rule then rewrites the rest
    assert got[1] == "fi"
    assert got[2] == "x \u0301"  # NFKC(acute) = blank + combining acute, which escapes the quote rule


def test_boilerplate_parity_and_lines(spark):
    vals = ["Thanks for reading\nbody", "#hiring now", "#hiringx stays", "body\nThanks for reading!\nmore"]
    parity = run(spark, lambda c: tx.clean_text(c, boilerplate=True), vals)
    assert parity == ["", "", "#hiringx stays", "body Thanks for reading! more"]
    lines = run(spark, lambda c: tx.remove_boilerplate(c), vals)
    assert lines == ["body", "", "#hiringx stays", "body\nmore"]


def test_emoji_count_and_density(spark):
    assert run(spark, tx.emoji_count, ["a\U0001F680b\u2600\ufe0f\u2705\U0001F9E0"]) == [4]
    text = " ".join(["w"] * 128) + " \U0001F680"
    assert run(spark, tx.emoji_density, [text]) == [0.007812]   # half-even at the 6th digit
    assert run(spark, tx.emoji_density, ["!!! \u2600"]) == [1.0]  # no words -> divide by 1
    assert run(spark, lambda c: tx.emoji_density(c, "per_char"), ["ab\u2600"]) == [round(1 / 3, 6)]


def test_word_tokens_unicode(spark):
    assert run(spark, tx.word_tokens, ["H\u00e9llo, w\u00d6rld_1 x2!"]) == [["h\u00e9llo", "w\u00f6rld_1", "x2"]]
