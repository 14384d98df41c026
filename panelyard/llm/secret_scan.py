"""Secret scan with a random forest that removes false positives.

1. ``candidates`` finds suspicious strings with three patterns: what is assigned to a
   name such as token or password, long runs of key characters, and the body of private
   keys. Each place of a
   candidate is a row with its neighbouring text, and is judged by that.
2. ``Profile`` is learned from the words of all documents: the most frequent words are
   the dictionary, which gives the letter pairs and 4-letter pieces of normal text.
3. ``with_features`` measures length, changes between kinds of characters, unusual letter
   pairs, dictionary coverage, path and neighbouring words, of the whole candidate.
4. A random forest trained from labelled findings (``train``) tells secrets from false
   positives. Without findings labelled by people, ``seed_label`` labels the clear
   cases, and the forest decides the others too; keys of a known form are secrets.

Everything is made of built-in functions and pyspark.ml stages. Training takes at most
``TRAIN_ROWS`` labelled findings of each class, chosen by hash.

Defined results: null and empty texts have no candidates; a null path counts as empty;
if the labelled findings are of one class only, there is no forest and the seed rule
decides; repeated rows give repeated findings; an empty table gives an empty result.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.llm.frames import at, named, numbered, or_empty, pick
from panelyard.session import staged

KEY_WORDS = ("token|secret|passwd|password|pwd|api[_-]?key|access[_-]?key|private[_-]?key|"
             "auth[a-z_-]{0,12}|credentials?|bearer")
ASSIGNED = rf"(?i)(?:{KEY_WORDS})[\"']?\s{{0,3}}(?::=|=>|=|:)\s{{0,3}}[\"']?([^\s\"'<>,;]{{8,}}+)"
RUN_SIGN = "[A-Za-z0-9+/_=-]"
RUN = rf"(?<!{RUN_SIGN}){RUN_SIGN}{{20,}}+"
_BREAK = r"(?:\s|\\[nr]){1,4}+"  # also as written in JSON
KEY_BODY = (rf"PRIVATE KEY(?: BLOCK)?-----{_BREAK}([A-Za-z0-9+/=]{{20,}}+(?:{_BREAK}[A-Za-z0-9+/=]{{20,}}+)*+"
            rf"(?:{_BREAK}[A-Za-z0-9+/=]{{1,19}}+(?={_BREAK}-----END))?+)")
# Forms that say by themselves what they are, and the text before the body of a private key.
KNOWN_KEY = (r"(?:^|=)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[oprsu]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{50,}|"
             r"[rs]k_live_[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}|"
             r"(?=[^=]*[0-9])(?:glpat-[A-Za-z0-9_-]{20,}|xox[abeprs]-[A-Za-z0-9-]{20,}|sk-[A-Za-z0-9_-]{40,}))\z")
KEY_HEADER = r"PRIVATE KEY(?: BLOCK)?-----(?:\s|\\[nr])*\z"
UUID = r"^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\z"
WHOLE_RUN = r"^[^A-Za-z0-9+/_=-][A-Za-z0-9+/_=-]{20,}\z"  # with the character before
HARMLESS_WORDS = (r"\b(?:example|sample|dummy|test|tests|sha1|sha256|md5|commit|checksum|uuid|isbn|order|"
                  r"phone)\b")
AROUND = 40  # characters of neighbouring text

DICTIONARY_WORDS = 2000
TRAIN_ROWS = 10_000
TREES, DEPTH, SEED = 20, 6, 11

FEATURES = ["length", "digits", "uppers", "class_changes", "odd_pairs", "coverage",
            "key_word", "known_key", "assigned", "quoted", "harmless", "path_depth", "path_harmless"]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


@dataclass(frozen=True)
class Profile:
    """Letter pairs and 4-letter pieces of the most frequent words."""

    pairs: tuple[str, ...]
    pieces: tuple[str, ...]

    @classmethod
    def of(cls, documents: DataFrame, text_col: str = "text") -> Profile:
        """Counts all words of all documents; the dictionary is the top of that."""
        words = pick(documents, text_col).toDF("text").select(
            F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z0-9]+")).alias("word"))
        # Letters between digits are no words: keys would make their own pieces normal.
        top = (words.where(F.col("word").rlike("^[a-z]{2,24}$")).groupBy("word").count()
               .orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS).collect())
        kept = [r["word"] for r in top]
        return cls(*(tuple(sorted({w[i:i + n] for w in kept for i in range(len(w) - n + 1)})) for n in (2, 4)))


def _running(sizes: str) -> Column:
    """What the sizes before each one sum up to. Blocks keep the copying of arrays small."""
    n = F.size(sizes)
    width = F.ceil(F.sqrt(n)).cast("int")
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int"))

    def block(b: Column) -> Column:
        return F.slice(sizes, b * width + 1, width)

    def sums(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0).cast("long")),
                           lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))

    bases = sums(F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0).cast("long"), lambda s, x: s + x)))
    # Zipped, so that the bases are not computed again for every block.
    each = F.filter(F.arrays_zip(blocks.alias("b"), bases.alias("base")), lambda e: e["b"].isNotNull())
    return F.flatten(F.transform(each, lambda e: F.transform(
        F.slice(sums(block(e["b"])), F.lit(1), F.size(block(e["b"]))), lambda s: s + e["base"])))


def _matched(rows: DataFrame, pattern: str, group: int, name: str) -> DataFrame:
    """``rows`` with the array ``name`` of all matches: start, candidate, before and after.

    ``group`` is the part of the match that is the candidate; it ends where the match ends.
    """
    text = F.col("text")
    cut = rows.withColumns({
        "gap": F.split(text, pattern, -1), "whole": F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        "value": F.regexp_extract_all(text, F.lit(pattern), F.lit(group))})
    cut = cut.withColumn("sizes", F.zip_with("gap", "whole", lambda g, w: (
        F.length(g) + F.coalesce(F.length(w), F.lit(0))).cast("long")))
    # One part is the text between two matches and the match after it; the last has no match.
    cut = cut.withColumn("parts", F.arrays_zip("gap", "whole", "value", _running("sizes").alias("ahead")))

    def joined(first: Column, n: Column, side) -> Column:
        return F.array_join(F.transform(F.slice("parts", first, n), lambda p: F.concat(
            side(p["gap"], F.lit(AROUND)), side(or_empty(p["whole"]), F.lit(AROUND)))), "")

    def match(p: Column, i: Column) -> Column:
        named_by = F.length(p["whole"]) - F.length(p["value"])
        # Matches and what is between them have 13 characters at least: four fill AROUND.
        before = F.concat(joined(F.greatest(i - 3, F.lit(1)), F.least(i, F.lit(4)), F.right),
                          F.right(p["gap"], F.lit(AROUND)), p["whole"].substr(F.lit(1), named_by))
        return F.struct((p["ahead"] + F.length(p["gap"]) + named_by).alias("start"), p["value"].alias("candidate"),
                        F.right(before, F.lit(AROUND)).alias("before"),
                        F.left(joined(i + 2, F.lit(4), F.left), F.lit(AROUND)).alias("after"))

    matches = F.transform(F.slice("parts", F.lit(1), F.size("parts") - 1), match)
    return cut.withColumn(name, matches).select(*rows.columns, name)


def candidates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path_col: str = "source") -> DataFrame:
    """One row per document and place of a candidate.

    Columns: id, path, text_hash, start (characters before it), candidate, before and
    after (neighbouring text). What two patterns find at the same place is one row.
    """
    rows = pick(documents, id_col, text_col, path_col).toDF("id", "text", "path")
    text = F.col("text")
    rows = rows.where(text.rlike(ASSIGNED) | text.rlike(RUN)).select(
        "id", or_empty(F.col("path")).alias("path"), F.xxhash64("text").alias("text_hash"), "text")
    found = _matched(_matched(_matched(rows, ASSIGNED, 1, "assigned"), RUN, 0, "run"), KEY_BODY, 1, "body")
    other = F.filter(F.concat("assigned", "body"), lambda m: ~(
        F.concat(F.right(m["before"], F.lit(1)), m["candidate"]).rlike(WHOLE_RUN) & ~m["after"].rlike(f"^{RUN_SIGN}")))
    return found.select("id", "path", "text_hash", F.inline(F.concat(other, "run")))


def with_features(found: DataFrame, profile: Profile) -> DataFrame:
    """``found`` with the columns ``FEATURES``."""
    c = F.col("candidate")
    low, n = F.lower(c), F.length(c)

    def share_in(size: int, known: tuple[str, ...]) -> Column:
        # Overlapping pieces of letters: time and room grow with the length only.
        letters = F.regexp_extract_all(low, F.lit(f"(?=([a-z]{{{size}}}))"), F.lit(1))
        found = F.filter(letters, lambda w: w.isin(*known) if known else F.lit(False))
        return _share(F.size(found), n - (size - 1))

    before, tail = F.lower("before"), F.lower(F.substring(F.col("before"), -4, 4))
    path = F.lower("path")
    changes = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
    features = {
        "length": n,
        "digits": F.regexp_count(c, F.lit("[0-9]")) / n,
        "uppers": F.regexp_count(c, F.lit("[A-Z]")) / n,
        "class_changes": F.regexp_count(c, F.lit(changes)) / n,
        "odd_pairs": 1 - share_in(2, profile.pairs),
        "coverage": share_in(4, profile.pieces),
        "key_word": before.rlike(KEY_WORDS),
        "known_key": c.rlike(KNOWN_KEY) | F.col("before").rlike(KEY_HEADER),
        "assigned": tail.rlike("[:=][ \"']*$"),
        "quoted": tail.rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        "harmless": before.rlike(HARMLESS_WORDS),
        "path_depth": F.regexp_count(path, F.lit("/")),
        "path_harmless": path.rlike(HARMLESS_WORDS),
    }
    return found.withColumns({k: v.cast("double") for k, v in features.items()})


def seed_label() -> Column:
    """1 and 0 for findings that are clear, null for the others.

    A random-looking string that is assigned to a key name, and a key of a known form, is a
    secret. Dictionary pieces are none, nor is, without a key name, what has no letters, one
    character only, the form of a UUID, or a harmless word before it. Other strings without
    a key name have no label: the forest decides by the string and its context.
    """
    c, harmless = F.col("candidate"), F.col("harmless") == 1
    random = (F.col("length") >= 16) & (F.col("digits").between(0.1, 0.9)) & (F.col("coverage") < 0.2)
    assigned = (F.col("key_word") == 1) & (F.col("assigned") == 1) & random
    plain = (F.col("coverage") >= 0.2) | harmless | c.rlike(r"^[^A-Za-z]*\z") | c.rlike(r"^(.)\1*\z") | c.rlike(UUID)
    return F.when((assigned | sure_key()) & ~harmless, F.lit(1)) \
        .when((F.col("coverage") > 0.6) | ((F.col("key_word") == 0) & (F.col("known_key") == 0) & plain), F.lit(0)) \
        .cast("double")


def sure_key() -> Column:
    """A key of a known form that does not read like words."""
    return (F.col("known_key") == 1) & (F.col("coverage") <= 0.6)


def train(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from findings with features and ``label``; none if one class is missing."""
    # Repeated findings count once, else one that is very frequent could fill the sample.
    hashed = labelled.select("label", *FEATURES, F.xxhash64("candidate", "before").alias("h")).distinct()
    rows = [hashed.where(F.col("label") == k).orderBy("h", *FEATURES).limit(TRAIN_ROWS) for k in (0.0, 1.0)]
    # A bounded sample in one partition: the forest does not depend on the cluster.
    sample = staged(rows[0].unionByName(rows[1]).repartition(1)
                    .sortWithinPartitions("label", "h", *FEATURES), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample))


def judged(found: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """Findings with ``probability`` of being a secret and ``is_secret``."""
    if forest is None:
        sure = F.coalesce(seed_label(), F.lit(0.0))
        return found.withColumns({"probability": sure, "is_secret": sure > 0.5})
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    scored = forest.transform(assembled)
    return scored.withColumn("probability", vector_to_array("probability")[1]) \
        .withColumn("is_secret", F.col("probability") > 0.5) \
        .drop("features", "rawPrediction", "prediction")


def scan(documents: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text", path_col: str = "source") -> DataFrame:
    """All findings of all documents: the id, start, length, candidate, probability, is_secret.

    ``labelled`` may bring findings labelled by people (columns of ``candidates`` and
    ``label``); else the clear findings of these documents are the training set.
    """
    profile = Profile.of(documents, text_col)
    found = staged(with_features(candidates(documents, id_col, text_col, path_col), profile), "candidates")
    known = found.withColumn("label", seed_label()) if labelled is None else with_features(labelled, profile)
    result = judged(found, train(known.where("label is not null")))
    if labelled is None:
        # Known forms are rare: the forest may not have met enough of them.
        sure = sure_key() & (F.col("harmless") == 0)
        result = result.withColumns({"probability": F.when(sure, 1.0).otherwise(F.col("probability")),
                                     "is_secret": sure | F.col("is_secret")})
    return result.select(F.col("id").alias(id_col), "text_hash", "start",
                         F.length("candidate").cast("long").alias("length"),
                         "candidate", "probability", "is_secret")


MASK = "[SECRET]"


def redacted(documents: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             length_col: str | None = "n_chars") -> DataFrame:
    """``documents`` with every verified secret of a text replaced, everywhere in it.

    What is a secret at one place of a text is masked at its other places too.
    Rows that are equal have equal findings, so documents meet theirs by id and text.
    ``length_col``, where there is one, becomes the length of the new text.
    """
    by_length = F.struct(F.length("candidate").alias("n"), "candidate")
    secrets = findings.where("is_secret").groupBy(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.sort_array(F.collect_set(by_length), asc=False).alias("_found"))
    text = at(documents, text_col)
    met = numbered(documents).join(secrets, at(documents, id_col).eqNullSafe(F.col("_id"))
                                   & (F.xxhash64(text) == F.col("_hash")), "left")
    # Longer ones first, in case one is a part of another.
    clean = F.aggregate("_found", text, lambda t, s: F.replace(t, s["candidate"], F.lit(MASK)))
    hit = F.col("_found").isNotNull()
    met = met.withColumn("_clean", F.when(hit, clean))
    new = {documents.columns.index(text_col): F.coalesce(F.col("_clean"), text)}
    if length_col in documents.columns:
        place = documents.columns.index(length_col)
        kind = documents.schema.fields[place].dataType
        new[place] = F.when(hit, F.length("_clean").cast(kind)).otherwise(F.col(f"c{place}"))
    return named(met.select(*[new.get(i, F.col(f"c{i}")).alias(f"c{i}") for i in range(len(documents.columns))]),
                 documents)
