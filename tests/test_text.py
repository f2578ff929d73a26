from pyspark.sql import functions as F

from reviewgate.functions import text as tx


def _one(spark, col, value):
    return spark.createDataFrame([(value,)], "text STRING").select(col(F.col("text")).alias("o")).first()["o"]


def test_normalize_text_is_stable(spark):
    assert _one(spark, tx.normalize_text, "  Fees\n\tWERE   charged. ") == "fees were charged."


def test_python_whitespace_and_nfkc(spark):
    assert _one(spark, tx.normalize_text, "a\x1cb c　D") == "a b c d"
    assert _one(spark, tx.normalize_text, "ﬁle") == "file"  # NFKC ligature


def test_hash_is_sha256_of_normalised(spark):
    import hashlib
    got = _one(spark, tx.narrative_hash, " Duplicate   narrative ")
    assert got == hashlib.sha256(b"duplicate narrative").hexdigest()


def test_slug(spark):
    assert _one(spark, tx.slug, "Money transfer, virtual currency, or money service") == \
        "money-transfer-virtual-currency-or-money-service"
    assert _one(spark, tx.slug, "  Credit card!! ") == "credit-card"


def test_input_validation(spark):
    rows = [("  A fictional complaint\nwith enough detail.  ",), ("too short",), (None,), ("x" * 6001,)]
    df = spark.createDataFrame(rows, "text STRING").select(
        tx.collapse_whitespace(F.col("text")).alias("c"), tx.input_status(F.col("text")).alias("s"))
    out = df.collect()
    assert out[0]["c"] == "A fictional complaint with enough detail."
    assert [r["s"] for r in out] == ["ok", "too_short", "not_text", "too_long"]


def test_character_windows_against_plain_python(spark):
    """Every window of every padded word, by code points: emoji, U+0000, one-letter words."""
    from reviewgate.operators.features import char_wb_terms
    texts = ["a\U0001F600bc d", "ab\x00cd", "x", "", "  two\twords ", "\U0001F600 \U0001F601\U0001F602", "\x00", "é è",
             "\U00010400\U00010401\U00010402\U00010403\U00010404\U00010405 q"]

    def windows(text):
        out = []
        for word in text.lower().split():
            padded = f" {word} "
            for n in range(3, 6):
                out += [padded[i:i + n] for i in range(len(padded) - n + 1)]
        return sorted(out)

    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = df.select("text", char_wb_terms(F.col("text")).alias("t")).collect()
    assert {r.text: sorted(r.t) for r in got} == {t: windows(t) for t in texts}
