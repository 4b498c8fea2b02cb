"""Toxicity by weak supervision.

Lexicon and pattern voters look at every document: general lexicons of several
languages, disguised spellings, and words and stems mined from two disjoint
halves of the labelled rows. A voter says how much it finds: nothing, one word, a
few or many, whatever the text's length. A generative label model estimates from the
votes of all documents how accurate each voter is in texts of each of four
lengths, as long texts have more hits by chance, and which voters go together,
and gives each pattern of votes a posterior; a linear classifier over hashed
words, votes, length and the density of hits is trained on the posteriors of
labelled rows, weighted so that each pattern counts as often as all documents
have it, and scores every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.common import SharedTables, crc32_text, labelled_ids, slices, small_batches
from tidefleet.llm.hashed import LETTERS, PACKED, Hasher, Rows, gathered, packed, sigmoid

#: General lexicons: plain words of abuse.
LEXICONS = {
    "nouns": "clown clowns creep dumbass fool fools freak idiot idiots imbecile jerk jerks loser losers moron morons pig pigs scum scumbag swine trash vermin",
    "adjectives": "brainless contemptible despicable disgusting dumb filthy hateful pathetic repulsive revolting stupid ugly worthless",
    "french": "abruti abrutis connard connards crétin crétins débile imbécile imbéciles minable ordure ordures pourriture raclure salaud salauds stupide",
    "german": "abschaum arschloch blödmann depp deppen drecksack erbärmlich idioten schwein schweine trottel vollidiot widerlich wertlos",
    "spanish": "asqueroso basura cabrón cerdo cerdos despreciable escoria estúpido estúpidos idiotas imbécil imbéciles inútil payaso",
}
WORDS = {name: frozenset(words.split()) for name, words in LEXICONS.items()}
#: Signs that stand for letters in disguised words.
DISGUISES = {"a": "@4", "e": "3", "i": "1!", "o": "0", "s": "$5", "t": "7"}
#: Labelled ids that lexicons and classifier are fitted on at most, chosen by the hash of their ids. The label model counts all documents.
LABELLED_ROWS = 8192
#: Words and stems of each half that are mined at most: the lexicons go to every task.
MINED_WORDS, MINED_STEMS, STEM = 400, 60, 5
#: A word is mined if toxic rows have it so many standard deviations more often than chance would.
BEYOND_CHANCE = 5.0
VOTERS = (*LEXICONS, "disguised", "words a", "words b", "stems a", "stems b")
#: Different words from which a voter's level is the next higher.
STEPS = (1, 2, 6)
LEVELS = len(STEPS) + 1
#: Voters whose votes go together this much, given the class, have joint tables, so many voters at most.
TOGETHER, MOST_TOGETHER = 0.2, 4
#: Different words from which a text is of the next length.
LENGTHS = (125, 500, 2000)
#: Documents of the table of all lengths that count in the table of each.
PRIOR = 30.0
#: Documents that the classifier is fitted as if on, where labelled rows are fewer.
LEAST_FITTED = 1000
WORD_SLOTS = 1 << 15
COUNT_SLOTS, SHARE_SLOTS = 8, 8
SLOTS = WORD_SLOTS + LEVELS * len(VOTERS) + len(LENGTHS) + 1 + COUNT_SLOTS + SHARE_SLOTS
EPOCHS, BATCH, RATE, DECAY = 10, 64, 0.1, 1e-4
TOXIC = 0.7

_hasher = Hasher(WORD_SLOTS)


def _disguised() -> re.Pattern:
    """Words of the English lexicons with at least one letter replaced or letters set apart by single signs."""
    plain = sorted((w for w in WORDS["nouns"] | WORDS["adjectives"] if len(w) > 3), key=lambda w: (-len(w), w))  # a plural before what it begins with
    spelled = ["".join(f"[{c}{DISGUISES.get(c, '')}]" for c in w) for w in plain]
    apart = [r"[.\-*_]".join(w) for w in plain]
    return re.compile(r"(?<!\w)(?:" + "|".join(spelled + apart) + r")(?!\w)")


_DISGUISED = _disguised()
#: What every disguised word has somewhere: a letter beside a sign or digit. Few texts do, and this is found faster.
_SUSPECT = re.compile(r"[a-z][.\-*_@4310!$57][a-z]|[@4310!$57][a-z]|[a-z][@430$57]")


@dataclass
class Lexicons:
    """What was learnt from either half of the labelled rows that aren't held out: words and stems that toxic documents have far more often."""

    words: tuple[frozenset[str], frozenset[str]] = (frozenset(), frozenset())
    stems: tuple[frozenset[str], frozenset[str]] = (frozenset(), frozenset())
    known: frozenset[str] = field(init=False)

    def __post_init__(self):
        self.known = frozenset().union(*WORDS.values(), *self.words)

    def votes(self, text: str | None) -> tuple[np.ndarray, int, set[str]]:
        """The level of each of VOTERS, how many different words any lexicon or stem has, and the different words."""
        lower = (text or "").lower()
        words = set(LETTERS.findall(lower))
        hits = words & self.known
        rest = {w[:STEM] for w in words if len(w) > STEM}
        found = [0] * len(VOTERS)
        if hits:
            found[: len(LEXICONS)] = [len(hits & w) for w in WORDS.values()]
        if _SUSPECT.search(lower):
            found[len(LEXICONS)] = len({x for x in _DISGUISED.findall(lower) if not x.isalpha()})
        at = len(LEXICONS) + 1
        for i in (0, 1):
            found[at + i] = len(hits & self.words[i])
            if stems := rest & self.stems[i]:
                found[at + 2 + i] = sum(w[:STEM] in stems for w in words if len(w) > STEM)
        # one word of a stem may be anything
        level = np.searchsorted(STEPS, [n - (i >= at + 2) for i, n in enumerate(found)], "right").astype(np.int8)
        return level, max(len(hits), *found[at + 2 :]), words


def length_of(words: int) -> int:
    """Which of the lengths a text of so many different words has."""
    return sum(words >= n for n in LENGTHS)


def _code(level: np.ndarray, length: int) -> int:
    return int((level.astype(np.int64) << 2 * np.arange(len(VOTERS))).sum()) + (length << 2 * len(VOTERS))


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(crc32_text(doc_id), F.lit(3)) == 1, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, labelled_rows: int, tables: SharedTables) -> DataFrame:
    """(id, text, toxic) written once: labelled_rows labelled ids at most that aren't held out; of an id's texts the least."""
    known = labelled_ids(labels.filter(~held_out(F.col("doc_id"))), "toxic", labelled_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    return tables.keep(texts.groupBy("id", "toxic").agg(F.min("text").alias("text")))


def mine(sample: DataFrame, most_words: int = MINED_WORDS, most_stems: int = MINED_STEMS) -> Lexicons:
    """Words and stems that mark toxic rows of either half of a sample, those that most rows have; a stem counts where two different words have it. Halves without both classes give none."""
    rows = sample.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).cast("int"))
    rows = rows.select("half", "id", (F.col("toxic") > 0).cast("int").alias("toxic"), "text")
    shares = {r["half"]: r["share"] for r in rows.groupBy("half").agg(F.avg("toxic").alias("share")).collect()}
    base = F.when(F.col("half") == 0, shares.get(0, 0.0)).otherwise(shares.get(1, 0.0))
    word = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    each = rows.select("half", "id", "toxic", F.explode(word).alias("word"))
    stems = each.filter(F.length("word") > STEM).groupBy("half", "id", "toxic", F.substring("word", 1, STEM).alias("word")).agg(F.count("*").alias("n")).filter("n > 1")

    def marks(found: DataFrame, most: int) -> tuple[frozenset[str], frozenset[str]]:
        counted = found.groupBy("half", "word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
        beyond = (F.col("toxic") - base * F.col("n")) / F.sqrt(base * (1 - base) * F.col("n"))
        good = counted.filter((base > 0) & (base < 1)).filter((F.col("toxic") >= 0.6 * F.col("n")) & (beyond >= BEYOND_CHANCE))
        best = [good.filter(F.col("half") == i).orderBy(F.desc("toxic"), "n", "word").limit(most).collect() for i in (0, 1)]
        return tuple(frozenset(r["word"] for r in b) for b in best)

    return Lexicons(marks(each, most_words), marks(stems, most_stems))


def levels_of(codes: np.ndarray) -> np.ndarray:
    """Rows of voters' levels from codes."""
    return codes[:, None] >> 2 * np.arange(len(VOTERS)) & 3


def fitted(levels: np.ndarray, length: np.ndarray, count: np.ndarray, known: np.ndarray, groups: list[list[int]], posterior: np.ndarray, rounds: int) -> np.ndarray:
    """Posteriors of a two-class model by expectation maximisation: groups of voters with joint tables for each length, independent of each other given class and length."""
    cells = [(levels[:, g] * LEVELS ** np.arange(len(g))).sum(1) for g in groups]
    lengths = len(LENGTHS) + 1
    for _ in range(rounds):
        mass = np.stack([count * (1 - posterior), count * posterior]) + known.T
        log = np.log(mass.sum(1, keepdims=True) + 1) * np.ones((1, len(levels)))
        for g, cell in zip(groups, cells, strict=True):
            size = LEVELS ** len(g)
            whole = np.stack([np.bincount(cell, m, size) for m in mass]) + 1.5 / size  # the same weight for a table of any size
            whole /= whole.sum(1, keepdims=True)
            # a length that few texts have follows the table of all
            table = np.stack([np.bincount(cell * lengths + length, m, size * lengths).reshape(size, lengths) for m in mass]) + PRIOR * whole[:, :, None]
            log = log + np.log(table / table.sum(1, keepdims=True))[:, cell, length]
        posterior = sigmoid(log[1] - log[0])
    return posterior


def together(levels: np.ndarray, weight: np.ndarray) -> list[list[int]]:
    """Voters in groups by how their levels correlate within either class; weight has a row of documents' weights for each class."""
    pairs = []
    for w in weight:
        if w.sum() > 0:
            centred = levels - (w[:, None] * levels).sum(0) / w.sum()
            spread = (w[:, None, None] * centred[:, :, None] * centred[:, None, :]).sum(0) / w.sum()
            scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
            link = np.abs(spread / scale[:, None] / scale)
            pairs += [(link[i, j], i, j) for i in range(levels.shape[1]) for j in range(i)]
    home = {i: [i] for i in range(levels.shape[1])}
    for strength, i, j in sorted(pairs, reverse=True):
        if strength > TOGETHER and home[i] is not home[j] and len(home[i]) + len(home[j]) <= MOST_TOGETHER:
            home[i].extend(home[j])
            for k in home[j]:
                home[k] = home[i]
    return [list(g) for g in {id(g): g for g in home.values()}.values()]


def label_model(patterns: dict[int, float], anchors: dict[tuple[int, int], float], rounds: int = 30) -> dict[int, float]:
    """Posterior of toxicity for each pattern of votes.

    patterns counts all documents with each pattern, anchors the labelled rows by
    (pattern, label). First every voter is a group of its own; then voters with a
    conditional correlation over TOGETHER are joined, and the model fitted again.
    """
    codes = np.array(sorted(patterns | {c: 0 for c, _ in anchors}), np.int64)
    count = np.array([patterns.get(c, 0.0) for c in codes.tolist()])
    known = np.array([[anchors.get((c, y), 0.0) for y in (0, 1)] for c in codes.tolist()]).reshape(-1, 2)
    levels, length = levels_of(codes), codes >> 2 * len(VOTERS)
    total = levels.sum(1)
    guess = np.where(total > 2, 0.95, np.where(total > 0, 0.5, 0.02))
    posterior = (known[:, 1] + guess) / (known.sum(1) + 1)  # where labelled rows have a pattern, they say what it means at first
    posterior = fitted(levels, length, count, known, [[i] for i in range(len(VOTERS))], posterior, rounds)
    groups = together(levels, np.stack([count * (1 - posterior), count * posterior]) + known.T)
    return dict(zip(codes.tolist(), fitted(levels, length, count, known, groups, posterior, rounds).tolist(), strict=True))


def vote_slots(level: np.ndarray, length: int) -> np.ndarray:
    """The slots of a pattern of votes and the text's length."""
    return np.append(WORD_SLOTS + LEVELS * np.arange(len(VOTERS)) + level, WORD_SLOTS + LEVELS * len(VOTERS) + length)


def features(level: np.ndarray, hits: int, words: set[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of one document: hashed words, each voter's level, the length, how many different words of the lexicons there are, and how dense they stand."""
    hashed = _hasher.slots_of(words)
    voted = vote_slots(level, length_of(len(words)))
    at = SLOTS - COUNT_SLOTS - SHARE_SLOTS
    share = min(SHARE_SLOTS - 1, int(20 * np.sqrt(hits / max(1, len(words)))))
    slots = np.concatenate([hashed, voted.astype(np.int32), np.array([at + min(COUNT_SLOTS - 1, hits), at + COUNT_SLOTS + share], np.int32)])
    return slots, np.concatenate([np.full(len(hashed), 1 / np.sqrt(max(1, len(hashed)))), np.ones(len(voted) + 2)]).astype(np.float32)


def weighed(codes: np.ndarray, patterns: dict[int, float]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Weights of rows with some patterns, the patterns that no row has, and their weights: each pattern in all weighs as all documents' counts say, one row on average 1."""
    scale = max(len(codes), LEAST_FITTED) / max(1.0, sum(patterns.values()))
    held = dict(zip(*np.unique(codes, return_counts=True), strict=True))
    bare = [c for c in sorted(patterns) if c not in held]
    return np.array([scale * patterns.get(int(c), 0.0) / held[c] for c in codes]), bare, np.array([scale * patterns[c] for c in bare])


def fit_linear(rows: Rows, target: np.ndarray, row_weight: np.ndarray, seed: int = 7) -> tuple[float, np.ndarray]:
    """Logistic regression on soft labels of weighted rows, by Adagrad."""
    rng = np.random.default_rng(seed)
    bias, weight, seen_b, seen = 0.0, np.zeros(SLOTS), 1e-3, np.full(SLOTS, 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            which = order[at : at + BATCH]
            part = rows.pick(which)
            g = row_weight[which] * (sigmoid(bias + part.sums(weight[part.slot] * part.value)) - target[which]) / len(which)
            slots, place = np.unique(part.slot, return_inverse=True)
            gw = np.bincount(place, np.repeat(g, np.diff(part.ends)) * part.value, len(slots)) + DECAY * weight[slots]
            seen[slots] += gw**2
            weight[slots] -= RATE * gw / np.sqrt(seen[slots])
            seen_b += g.sum() ** 2
            bias -= RATE * g.sum() / np.sqrt(seen_b)
    return bias, weight


def classify(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, mined_words: int = MINED_WORDS, mined_stems: int = MINED_STEMS) -> DataFrame:
    """Per row of docs: doc_id, held_out, score (0 to 1), predicted (1 if score >= TOXIC).

    Null and empty texts have no words and are scored by their votes; texts of
    any length are read whole; a score of just TOXIC is predicted 1; null ids are
    not held out; repeated rows get a result each; an empty table gives none;
    without labelled rows the general lexicons and the label model remain. Only
    text and doc_id are read. Votes don't depend on a text's length; how much
    they say in texts of that length is learnt from all documents.
    """
    sample = sampled(docs, labels, labelled_rows, SharedTables(docs.sparkSession))
    lexicons = mine(sample, mined_words, mined_stems)

    def code_of(found: tuple[np.ndarray, int, set[str]]) -> int:
        return _code(found[0], length_of(len(found[2])))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [code_of(lexicons.votes(t)) for part in slices(batch, "text") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(each, pa.int64()), batch.column("toxic")], ["code", "toxic"])

    # a row for each pattern of votes, as many as levels allow at most
    votes = lambda rows: small_batches(rows).mapInArrow(coded, "code long, toxic int").groupBy("code", "toxic").count().collect()
    counted = votes(docs.select("text", F.lit(None).cast("int").alias("toxic")))
    known = votes(sample.select("text", "toxic"))
    patterns = {r["code"]: float(r["count"]) for r in counted}
    posterior = label_model(patterns, {(r["code"], int(r["toxic"] > 0)): float(r["count"]) for r in known})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicons.votes(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*packed([features(*f) for f in found]), pa.array([code_of(f) for f in found], pa.int64())], ["slots", "row_values", "code"])

    found, codes = gathered(sample.select("text").mapInArrow(rows, f"{PACKED}, code long"), "code")
    row_weight, bare, bare_weight = weighed(codes, patterns)
    alone = [vote_slots(levels_of(np.array([c]))[0], c >> 2 * len(VOTERS)).astype(np.int32) for c in bare]
    more = Rows.of([(s, np.ones(len(s), np.float32)) for s in alone])
    found = Rows(np.concatenate([found.slot, more.slot]), np.concatenate([found.value, more.value]), np.concatenate([found.ends, found.ends[-1] + more.ends[1:]]))
    target = np.array([posterior[int(c)] for c in [*codes, *bare]])
    bias, weight = fit_linear(found, target, np.concatenate([row_weight, bare_weight])) if len(found) else (0.0, np.zeros(SLOTS))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                part = Rows.of([features(*lexicons.votes(t)) for t in batch.column("text").to_pylist()])
                score = sigmoid(bias + part.sums(weight[part.slot] * part.value)) if len(part) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scores = small_batches(docs.select("doc_id", "text")).mapInArrow(scored, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))
