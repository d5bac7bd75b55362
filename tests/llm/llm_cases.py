"""Rows that every operator on documents must handle."""

import random

CLASHING = (
    "n_words string, detections string, _group string, _rank string, _block string, _ghost string, node string, "
    "component string, row string, symbols string, leaf string, rank string, held_out string, score string, "
    "text_hash string, set_key string, length string, start string, kind string"
)
N_CLASHING = CLASHING.count(",") + 1

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


def words(seed, n):
    pick = random.Random(seed)
    return [pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n)]


def odd_texts():
    """Null, empty, no letters, one word, repeated rows, very long, unusual letters."""
    long = " ".join(words(1, 30_000))
    return [
        (0, None), (1, ""), (2, "  \n\t "), (3, "###!!! 123"), (4, "word"), (5, "same text in two rows"),
        (5, "same text in two rows"), (6, "same text in two rows"), (7, long), (8, "x" * 20_000),
        (9, "Ünïcödé ΑΣ İ ½ 中文 😀 \u0000 \x1c\x85 end"), (None, "no id at all"), (10, "A\r\nB\r\n\r\nC"),
    ]


def documents(spark, rows, extra=False):
    """A table of documents; `extra` adds columns whose names operators use inside."""
    full = [(i, t, "en", "src", len(t) if t is not None else None) for i, t in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    if extra:
        return spark.createDataFrame([(*r, *["x"] * N_CLASHING) for r in full], f"{schema}, {CLASHING}")
    return spark.createDataFrame(full, schema)


def plain(frame, *order):
    """Rows as tuples, sorted by their text form."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
