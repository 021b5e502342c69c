"""Random texts: column functions against plain Python string handling."""

import random

from pyspark.sql import functions as F

from affinitext.functions import text as t

ALPHABET = ["M", "m", ".", " ", "é", "²", "_", "Mme", "-", "%", "5", "٣", "’", "km", "\n", "𝐀", "!", "a"]


def texts(n=400):
    rng = random.Random(11)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(n)]


def is_word(char):
    return char.isalnum() or char == "_"


def honorifics(text):
    out, i = [], 0
    while i < len(text):
        if text[i] in "Mm" and text[i + 1:i + 2] == "." and not (i and is_word(text[i - 1])):
            out.append("monsieur")
            i += 2
        else:
            out.append(text[i])
            i += 1
    return "".join(out).replace("Mme", "madame")


def unit_word(text, name="m2", symbol="m²"):
    out, i = [], 0
    while i < len(text):
        end = i + len(name)
        free = not (i and is_word(text[i - 1])) and not (end < len(text) and is_word(text[end]))
        if text.startswith(name, i) and free:
            out.append(symbol)
            i = end
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def compare(spark, values, expression, expected):
    df = spark.createDataFrame(list(enumerate(values)), "i long, c string")
    got = {r["i"]: r["r"] for r in df.select("i", expression(F.col("c")).alias("r")).collect()}
    for i, value in enumerate(values):
        assert got[i] == expected(value), repr(value)


def test_honorifics(spark):
    compare(spark, texts(), t.expand_honorifics, honorifics)


def test_units(spark):
    values = [x.replace("5", "m2").replace("km", " m2 ") for x in texts()]
    compare(spark, values, lambda c: t.abbreviate_units(c, {"m2": "m²"}), unit_word)


def test_strip(spark):
    compare(spark, texts(), t.strip_chars, lambda x: x.strip(t.STRIP_CHARS))


def test_numbers(spark):
    values = [x.replace("M", "").replace("m", "") for x in texts()] + ["5", "²5", "٣٣"]
    compare(spark, values, t.is_number, str.isdigit)


def test_lemma_parts(spark):
    gaps = str.maketrans(dict.fromkeys(t.LEMMA_PUNCTUATION, " "))
    compare(spark, texts(), t.split_lemma, lambda x: x.translate(gaps).split())
