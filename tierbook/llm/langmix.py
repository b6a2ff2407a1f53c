"""Language identification as inference in a mixture of languages.

Each language is a distribution over hashed byte trigrams (letters lower-cased
within ASCII, everything that is no letter one blank), learned by counting in
every labelled training document. A document's trigrams come from a mixture of
languages; expectation-maximisation estimates the proportions. The set of
languages is chosen by penalised likelihood: starting from all languages with
a share, the weakest leaves as long as the log-likelihood, per independent
trigram, falls by less than half the logarithm of the number of trigrams (the
Bayesian information criterion). The prediction is the language with the
largest share in the chosen set; its share is the score. ``gain`` tells how
well all chosen languages together explain the text: its log-likelihood per
trigram above that of equally frequent trigrams; text in none of the learned
alphabets and noise fall below zero.

Texts are read whole; counting is one pass with a partial sum per task, and
prediction is one pass without a shuffle, at most ``ROWS`` documents at a time
whatever their length. The model holds ``FEATURES`` numbers
per language, for at most ``MAX_LANGUAGES`` languages (an error beyond it).

Edge cases: texts that are null or hold no letter are ``und`` with score and
gain 0, as is everything when no document can be learned from; labels that are null
teach nothing; of languages with one share the first by code point wins;
repeated rows are predicted each; all other columns come back in the struct
``rest``, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import packed_rest

FEATURES = 4096
SMOOTHING = 0.5
ROUNDS = 8
MIN_SHARE = 0.01
OVERLAP = 3.0  # each byte is in three trigrams
MAX_LANGUAGES = 512
ROWS = 256
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(128)]


def trigrams(docs: list[bytes], features: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of each byte trigram that holds a letter; texts are framed by blanks."""
    buf, starts = tk.joined([b"", *docs])
    buf = _FOLD[buf].astype(np.uint32)
    a, b, c = buf[:-2], buf[1:-1], buf[2:]
    doc = np.repeat(np.arange(len(docs)), np.diff(starts[1:]))
    # a trigram belongs to the document of its middle byte
    owner = np.concatenate([[-1], doc])[1 : len(buf) - 1]
    good = ((a != 32) | (b != 32) | (c != 32)) & (owner >= 0)
    # the separator itself as middle byte would join two documents
    middle = np.ones(len(buf), dtype=bool)
    middle[starts[1:] - 1] = False
    good &= middle[1:-1]
    code = (a[good] << np.uint32(16)) | (b[good] << np.uint32(8)) | c[good]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(12)
    return owner[good], (code % np.uint32(features)).astype(np.int64)


def _counts(features: int):
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in tk.chunks(batch):
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                doc, feature = trigrams(tk.texts(part.column("text")), features)
                for lang in set(langs):
                    seen = np.bincount(feature[(langs == lang)[doc]], minlength=features)
                    total[lang] = total.get(lang, 0) + seen
        for lang, seen in total.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(seen[at].astype(np.int64))], names=["lang", "feature", "n"]
            )

    return run


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", features: int = FEATURES) -> tuple[list[str], np.ndarray]:
    """(languages, trigram probabilities by language) of all labelled documents."""
    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    summed = labelled.mapInArrow(_counts(features), "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    by_lang = summed.groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("counts"))
    rows = sorted(by_lang.limit(MAX_LANGUAGES + 1).collect(), key=lambda r: r["lang"])
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((len(rows), features), SMOOTHING)
    for i, row in enumerate(rows):
        for cell in row["counts"]:
            table[i, cell["feature"]] += cell["n"]
    return [r["lang"] for r in rows], (table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _fit(counts: np.ndarray, model: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log-likelihood of each document over its allowed languages, by expectation-maximisation."""
    n = counts.sum(axis=1)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        ratio = counts / (share @ model)
        share = share * (ratio @ model.T) / n[:, None]
        share /= share.sum(axis=1, keepdims=True)
    likelihood = (counts * np.log(share @ model)).sum(axis=1, dtype=np.float64)
    return share, likelihood


def proportions(counts: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Each document's language shares over the set that the penalised likelihood chooses (rows of counts are not empty)."""
    return choose(counts, model)[0]


def choose(counts: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``proportions`` and the log-likelihood of each document under them."""
    share, likelihood = _fit(counts, model, np.ones((len(counts), len(model)), dtype=np.float32))
    result, penalty = share.copy(), 0.5 * OVERLAP * np.log(counts.sum(axis=1))
    # languages without a real share go at once
    allowed = share >= np.minimum(MIN_SHARE, share.max(axis=1, keepdims=True))
    open_ = np.arange(len(counts))
    trimmed = np.flatnonzero(~allowed.all(axis=1))
    if len(trimmed):
        result[trimmed], likelihood[trimmed] = _fit(counts[trimmed], model, allowed[trimmed].astype(np.float32))
    while len(open_ := open_[allowed[open_].sum(axis=1) > 1]):
        weakest = np.where(allowed[open_], result[open_], np.inf).argmin(axis=1)
        fewer = allowed[open_].copy()
        fewer[np.arange(len(open_)), weakest] = False
        share, less = _fit(counts[open_], model, fewer.astype(np.float32))
        better = likelihood[open_] - less < penalty[open_]
        open_, share, less, fewer = open_[better], share[better], less[better], fewer[better]
        result[open_], likelihood[open_], allowed[open_] = share, less, fewer
    return np.where(allowed, result, 0), likelihood


def _predict(languages: list[str], model: np.ndarray):
    features = model.shape[1]

    def run(batches):
        for batch in batches:
            for part in (whole.slice(at, ROWS) for whole in tk.chunks(batch) for at in range(0, whole.num_rows, ROWS)):
                docs = tk.texts(part.column("text"))
                lettered = [bool(_LETTER.search(t or "")) for t in part.column("text").to_pylist()]
                doc, feature = trigrams(docs, features)
                counts = np.bincount(doc * features + feature, minlength=len(docs) * features).reshape(len(docs), features).astype(np.float32)
                known = np.flatnonzero(np.array(lettered) & (counts.sum(axis=1) > 0)) if languages else np.zeros(0, int)
                lang, score, gain = [UNDETERMINED] * len(docs), np.zeros(len(docs)), np.zeros(len(docs))
                if len(known):
                    share, likelihood = choose(counts[known], model)
                    gain[known] = likelihood / counts[known].sum(axis=1) + np.log(features)
                    best = share.argmax(axis=1)
                    score[known] = np.clip(share[np.arange(len(known)), best], 0, 1)
                    for i, b in zip(known, best):
                        lang[i] = languages[b]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text"), pa.array(lang, pa.string()), pa.array(score), pa.array(gain), part.column("rest")],
                    names=["id", "text", "lang_pred", "score", "gain", "rest"],
                )

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, text, lang_pred, score, gain`` and all other columns in the struct ``rest``."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), packed_rest(docs, id_col, text_col).alias("rest"))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.mapInArrow(_predict(*model), f"id {kinds['id']}, text string, lang_pred string, score double, gain double, rest {kinds['rest']}")


def held_out(id_col: str = "doc_id", parts: int = 5, remainder: int = 0):
    """Whether crc32 of the id as text leaves ``remainder``; true for a null id, which is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == remainder, F.lit(True))
