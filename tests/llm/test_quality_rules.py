import random
import re

from pyspark.sql import functions as F

from panelyard.llm.quality_rules import apply_rules

PROSE = ("the river and the town were quiet in the morning and a boat came from the north with "
         "letters for the old house on the hill where nobody had lived since the long winter of "
         "that year so people said it was better to leave them at the door and go home again "
         "before the rain began to fall")


def by_hand(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
            "base_failed": n < 50 or 100 * len(hit) > 50 * n}


def test_counts_match_brute_force(docs):
    rng = random.Random(7)
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "x " * 300, "no no no no", "é ñ # | a",
             "line\nline\n\nline", PROSE, PROSE + "\n" + PROSE, "word" * 5000, "a\x0bb\x0cc\rd\xa0e"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [rng.choice(["\n", " ", "\t\n"]).join(rng.choice(["to be", "or", "#", "x!"])
                                                  for _ in range(rng.randint(0, 40))) for _ in range(40)]
    rows = {r["doc_id"]: r for r in apply_rules(docs(list(enumerate(texts)))).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert {k: rows[i][k] for k in by_hand(text)} == by_hand(text), repr(text)


def test_verdicts(docs):
    lines = [(1, PROSE), (2, " ".join(w + "***" for w in PROSE.split())), (3, PROSE.upper().replace(" ", "!! ")),
             (4, "\n".join(["the sun and the moon"] * 30)), (None, PROSE), (1, PROSE)]
    got = sorted(((r["doc_id"] or 0), r["kept"]) for r in apply_rules(docs(lines)).collect())
    assert got == [(0, True), (1, True), (1, True), (2, False), (3, False), (4, False)]


def test_filter_above_does_not_repeat_the_work(docs):
    long = docs([(i, f"{PROSE} {i} " * 400) for i in range(20)])
    assert apply_rules(long).where(~F.col("kept")).count() == 20


def test_empty_table_and_clashing_names(docs):
    assert apply_rules(docs([])).count() == 0
    odd = docs([(1, PROSE)]).withColumn("n_words", F.lit("x")).withColumn("m", F.lit(1)) \
        .withColumn("words", F.lit(1)).withColumn("kept", F.lit(None)).withColumnRenamed("source", "TEXT")
    assert apply_rules(odd).first()["n_words"] == len(PROSE.split())
