"""Quality rules by weak supervision.

Each rule votes a document good (+1), bad (-1) or abstains (0).  Votes are counted by
pattern over all documents; the table of patterns is bounded by 3 ** len(RULES), whatever the
corpus.  On it expectation-maximisation estimates, without labels, the share of good documents
and the accuracy of each rule.  A document is kept if the posterior
probability that it is good is at least one half, so no single rule decides.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import WHITE, checkpointed, col, text_of

#: Fixed by the contract: characters that count as symbols; the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Frequent words of a few languages.  A share of them tells prose from lists and noise.
FUNCTION_WORDS = frozenset((
    "the of and to in a is that it for as was with be by on not he his this are or from at which "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un une du dans que est pour qui sur par avec pas au "
    "el los las y del se por con una su para es al lo como más o"
).split())
#: The longest word that is looked up among the function words.
LONGEST = 8
#: Base figures, and what else the rules look at.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_function", "n_upper", "n_letters", "n_bangs", "n_ended", "n_lines", "n_plain", "n_distinct")
#: (name, share, good within, bad outside): a rule votes good within its first bounds (None: it never votes good),
#: bad outside its second, and abstains otherwise.  Rules that look for damage abstain where they find none;
#: rules that look for prose vote either way.
RULES = (
    ("symbols", lambda f: f["n_symbols"] / f["n_words"], None, (0.0, 0.10)),
    ("dup_lines", lambda f: f["n_dup_lines"] / np.maximum(f["n_lines"], 1), None, (0.0, 0.30)),
    ("repeats", lambda f: f["n_repeat_words"] / f["n_words"], None, (0.0, 0.40)),
    ("upper_case", lambda f: f["n_upper"] / np.maximum(f["n_letters"], 1), None, (0.0, 0.40)),
    ("bangs", lambda f: f["n_bangs"] / f["n_words"], None, (0.0, 0.15)),
    ("variety", lambda f: f["n_distinct"] / np.sqrt(f["n_words"]), None, (1.5, np.inf)),
    ("word_length", lambda f: f["word_chars"] / f["n_words"], None, (2.0, 12.0)),
    ("function_words", lambda f: f["n_function"] / f["n_words"], (0.12, 0.90), (0.05, 0.95)),
    ("sentences", lambda f: f["n_ended"] / f["n_words"], (0.035, 0.40), (0.01, 0.60)),
    ("plain_words", lambda f: f["n_plain"] / f["n_words"], (0.85, 1.0), (0.70, 1.0)),
)


_ENDS = frozenset(b".!?")


def repeated_words(words: list) -> int:
    """Words within three-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))  # noqa: B905  the shortest ends it
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    again = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def figures(text: str) -> tuple[int, ...]:
    """BASE and MORE of a whole text; all zero for a text without words."""
    words = text.encode().split()  # on bytes: ASCII white space only
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    if not words:
        return (0,) * (len(BASE) + len(MORE))
    counts = Counter(words)
    chars = len(text) - sum(map(text.count, WHITE))
    lower, upper = text.lower(), text.upper()
    letters = sum(map(str.__ne__, lower, upper)) if len(lower) == len(upper) == len(text) else sum(map(str.isalpha, text))
    known = plain = bangs = 0
    for word, n in counts.items():
        w = word.decode()
        core = w.lstrip("\"'(").removesuffix(")")
        if core and not core[-1].isalpha():
            core = core[:-1]  # one mark at the end belongs to prose, more don't
        if core.isalpha() and (len(core) == 1 or core[1:].islower()):
            plain += n
            if len(core) <= LONGEST and core.lower() in FUNCTION_WORDS:
                known += n
        if w[-1] == "!":
            bangs += n
    # a sentence ends at a mark after which a capital or nothing follows
    ended = sum(1 for w, after in zip(words, [*words[1:], b"A"], strict=True) if w[-1] in _ENDS and after.decode()[0].isupper())
    return (
        len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
        known, sum(map(str.isupper, text)), letters, bangs, ended, len(lines), plain, len(counts),
    )


def votes(f: dict[str, np.ndarray]) -> np.ndarray:
    """(documents, rules) of -1, 0, 1; documents without words get no votes."""
    some = f["n_words"] > 0
    f = {k: np.where(some, v, 1) for k, v in f.items()}
    out = np.zeros((len(some), len(RULES)), np.int8)
    for j, (_, share, good, fair) in enumerate(RULES):
        x = share(f)
        yes = (x >= good[0]) & (x <= good[1]) if good else False
        out[:, j] = np.where(yes, 1, np.where((x < fair[0]) | (x > fair[1]), -1, 0))
    out[~some] = 0
    return out


#: A rule counts for no more than this accuracy, so that two rules can outvote one.
MOST = 0.97


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """EM over vote patterns: (share of good documents, accuracy of each rule where it votes).

    Every rule starts as right in four of five votes; five pseudo-votes of that kind hold rules that hardly vote.
    """
    n = counts.astype(float)
    good, accuracy = 0.5, np.full(patterns.shape[1], 0.8)
    for _ in range(rounds):
        p = posterior(patterns, good, accuracy)[:, None]
        right = np.where(patterns > 0, p, np.where(patterns < 0, 1 - p, 0.0))
        new = ((n[:, None] * right).sum(axis=0) + 4.0) / ((n[:, None] * (patterns != 0)).sum(axis=0) + 5.0)
        accuracy, before = np.clip(new, 0.5, MOST), accuracy
        good = float((n * p[:, 0]).sum() + 2.5) / float(n.sum() + 5.0)
        if np.abs(accuracy - before).max(initial=0.0) < 1e-9:
            break
    return good, accuracy


def posterior(patterns: np.ndarray, good: float, accuracy: np.ndarray) -> np.ndarray:
    """P(good | votes), rules taken as independent given the class; a rule that abstains says nothing."""
    weight = np.log(accuracy) - np.log1p(-accuracy)
    return 1 / (1 + np.exp(-(np.log(good) - np.log1p(-good) + patterns @ weight)))


def rule_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, BASE, MORE, pattern): whole-text figures and the votes, one character a rule (0 bad, 1 abstains, 2 good)."""
    kind = docs.select(col(id_col)).schema[0].dataType.simpleString()
    names = [*BASE, *MORE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("t")
            table = np.array([figures(texts[i].as_py()) for i in range(len(texts))], np.int64).reshape(-1, len(names))
            f = {name: table[:, j] for j, name in enumerate(names)}
            pattern = ["".join(map(str, row)) for row in (votes(f) + 1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(f[x]) for x in names], pa.array(pattern, pa.string())], ["id", *names, "pattern"])

    rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, " + ", ".join(f"{x} long" for x in names) + ", pattern string")


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, BASE figures, base_failed, kept, p_good.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated three-word windows.  ``kept`` is
    false for those, else whether ``p_good`` is at least 0.5.  Null counts as the empty text, which has no words and
    fails the base.  Rows that repeat an id are judged each on its own.  An empty table gives an empty result.
    """
    rows = checkpointed(rule_figures(docs, id_col, text_col))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counted = rows.groupBy("pattern").count().collect()  # at most 3 ** len(RULES) rows
    counted.sort()
    patterns = np.array([[int(x) - 1 for x in r["pattern"]] for r in counted], np.int64).reshape(len(counted), len(RULES))
    good, accuracy = fit(patterns, np.array([r["count"] for r in counted], np.int64))
    p = posterior(patterns, good, accuracy)
    known = docs.sparkSession.createDataFrame([(r["pattern"], float(x)) for r, x in zip(counted, p, strict=True)],
                                              "pattern string, p_good double")
    out = rows.join(F.broadcast(known), "pattern")  # the same bound
    return out.select("id", *BASE, failed.alias("base_failed"), (~failed & (F.col("p_good") >= 0.5)).alias("kept"), "p_good")
