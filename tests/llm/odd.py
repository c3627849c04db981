"""Tables with everything that operators have to bear."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))

# Names that operators use for columns of their own.
CLASHES = (
    "row doc digit group group_size keep_id kept parent size part first taken passes upper lower"
    " start end target blocks order_key text_hash lang_pred score held_out ids n place at class"
    " class_id band key hub rep high low label bucket host html_text removed component"
).split()


def documents(spark):
    rows = [
        (0, "The quick brown fox jumps over the lazy dog near the river bank.", "en", "b", 1),
        (1, "The quick brown fox  jumps\nover the lazy dog near the river bank.", "en", "b", 1),
        (2, None, "en", "a", None),
        (3, "", None, "a", 0),
        (4, " \n\t ", "en", None, 4),
        (5, LONG, "en", "a", len(LONG)),
        (6, LONG, "de", "a", len(LONG)),
        (7, "12345 !!! 678", "en", "b", 13),
        (8, "Der schnelle braune Fuchs springt über den faulen Hund.", "de", None, 50),
        (8, "Der schnelle braune Fuchs springt über den faulen Hund.", "de", None, 50),
        (9, "short", "fr", "", 5),
        (9, "another text of the same number", "fr", "", 5),
        (None, "a row without a number", "en", "b", 22),
        (None, "a row without a number", "en", "b", 22),
        (10, "Ünïcödé 中文 😀 e\u0301 \u00a0 x", "en", "c", 10),
        (11, "short", "fr", "c", 5),
    ]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    return frame.withColumns({name: F.lit(f"own {name}") for name in CLASHES})


def nothing(spark):
    return documents(spark).where("false")
