"""Frames with the awkward rows that every operator must take."""

from pyspark.sql import functions as F

LONG = "Long words make a long text. " * 4000

EDGE_TEXTS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c d"), (6, "Grüße, naïve Straße! \U0001f600 ok"),
    (7, "the same text in several rows, with quite enough words"), (7, "the same text in several rows, with quite enough words"),
    (8, "the same text in several rows, with quite enough words"), (None, "a row without an id but with enough words to count"),
    (None, None), (9, LONG), (10, "12345 !!! ???"), (11, "  "), (7, "the same id with another text"),
]

#: Names that the operators use inside, or give to their own results.
CLASHES = (
    "n key node label kept component_id text_hash size source_size target taken score lang_pred letters kind gram hits items "
    "n_words secret_spans _s_key _s_text bucket ticket known weight total words rate prefix digest host path rule verdict header "
    "payload sha256 vector a b owner rows"
).split()


def documents(spark, rows=None, clashes=True):
    rows = EDGE_TEXTS if rows is None else rows
    frame = spark.createDataFrame(
        [(i, t, "en" if k % 3 else None, f"src{k % 3}" if k % 4 else None, len(t or "")) for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    return with_clashes(frame) if clashes else frame


def with_clashes(frame):
    return frame.withColumns({name: F.lit(name) for name in CLASHES if name not in frame.columns})


def empty(frame):
    return frame.filter("false")
