"""Small tables with every odd case, for all operators of the subpackage."""

import re

import public_tokenizers

WORD = re.compile("[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Lorem IPSUM dolor, sit amet. " * 4000

ROWS = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, " \n\t", "en", None, 3),
    (4, "one two three four five", "en", "b", 23),
    (5, "one two three four five", "en", "b", 23),
    (5, "one two three four five", "en", "b", 23),
    (6, "ONE two three\tfour five ", "en", "b", 24),
    (7, LONG, "la", "c", len(LONG)),
    (8, LONG + "x", "la", "c", len(LONG) + 1),
    (9, "12 34 !!", "xx", "", 8),
    (None, "no id here", None, None, 10),
    (10, "Üben   é́ <|endoftext|> it's  don't\x0bnow", "de", "b", 30),
]
#: Names that the operators use themselves.
CLASHES = {"score": "'kept'", "fp": "1", "size": "2", "key": "'k'", "range": "3", "mix_key": "4", "mix_size": "5", "mix_plan": "6",
           "simhash": "7", "quality_score": "8", "text_hash": "9", "gone_lines": "10", "plan_source": "'p'", "plan_range": "11", "row_a": "12", "row_b": "13", "apart": "14", "mix_range": "15", "mix_before": "16", "mix_copy": "17",
           "held_out": "true", "word": "'w'"}


def documents(spark, rows=ROWS, clashes=True):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *(f"{v} AS {k}" for k, v in CLASHES.items())) if clashes else df


def words(text):
    return WORD.findall(text or "")
