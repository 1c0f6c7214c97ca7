"""Pluggable aspect-sentiment scorers.

A scorer adds ``aspect_sentiments`` (``MAP<STRING, STRING>``: aspect -> one of
NONE/NEG/POS/NEU) to a DataFrame that has a text column. Null text gives a
null map; the row is kept.

* ``LexiconScorer`` — cue-word rules written as native expressions (no Python
  on executors); exact against SQL engines.
* ``CnnScorer`` — the convolutional model (embedding -> conv k=5 -> ReLU ->
  max over all positions -> dense 128 ReLU -> 8 heads x 4) run in NumPy inside
  an Arrow (pandas) UDF; tokens and the final argmax/decode stay JVM-side.
"""

from __future__ import annotations

import json
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ASPECTS, HEAD_MAX_LEN, HELD_VOCAB, PAD_ID, SENTIMENTS, UNK_ID
from ..functions.arrays import argmax, aspect_map, index_to_sentiment
from ..functions.text import cut, token_ids, tokens

# --- fixed values: default cue-word lexicon (our own; en, fr, de, es) ---
DEFAULT_ASPECT_WORDS = {
    "Price": ["price", "cost", "cheap", "expensive", "prix", "cher", "preis", "teuer", "billig", "precio", "caro", "barato"],
    "Shipping": ["shipping", "delivery", "shipped", "livraison", "livré", "lieferung", "versand", "envío", "entrega"],
    "Outlook": ["look", "design", "color", "colour", "style", "couleur", "aussehen", "farbe", "aspecto", "diseño"],
    "Quality": ["quality", "material", "durable", "qualité", "qualität", "calidad"],
    "Size": ["size", "fit", "small", "large", "taille", "größe", "talla", "tamaño"],
    "Shop_Service": ["service", "seller", "shop", "store", "vendeur", "boutique", "verkäufer", "vendedor", "tienda", "servicio"],
    "General": ["product", "overall", "produit", "produkt", "producto"],
    "Others": ["other", "else", "autre", "andere", "otro"],
}
DEFAULT_POSITIVE = ["good", "great", "excellent", "love", "best", "nice", "perfect", "bon", "bonne", "bien", "parfait",
                    "gut", "toll", "super", "bueno", "buena", "excelente", "genial", "mejor"]
DEFAULT_NEGATIVE = ["bad", "poor", "terrible", "worst", "broken", "not", "no", "never", "mauvais", "pas", "jamais",
                    "schlecht", "nicht", "kein", "nie", "malo", "mala", "nunca", "sin"]
# --- end of fixed values ---


class Scorer:
    output = "aspect_sentiments"

    def score(self, df: DataFrame, text_col: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError


def _member_of(words: list[str]):
    """One-argument lambda for higher-order functions (a second argument would be read as the index)."""
    return lambda t: t.isin(*words)


class LexiconScorer(Scorer):
    """Aspect is mentioned when one of its cue words occurs (``General`` also when
    any polarity word occurs); a mentioned aspect is POS when positive words
    outnumber negative ones, NEG when the reverse, else NEU; otherwise NONE."""

    def __init__(self, aspect_words: dict[str, list[str]] | None = None,
                 positive: list[str] | None = None, negative: list[str] | None = None):
        self.aspect_words = aspect_words or DEFAULT_ASPECT_WORDS
        self.positive = positive or DEFAULT_POSITIVE
        self.negative = negative or DEFAULT_NEGATIVE

    def score(self, df: DataFrame, text_col: str) -> DataFrame:
        # Three projections, so each expensive value is computed once per row:
        # tokens (one regex pass), then polarity counts and aspect mentions, then
        # the map. Catalyst does not inline a non-trivial alias referenced many
        # times. Mentions use arrays_overlap (hash lookup, code-generated).
        toks = F.col("_toks")
        step1 = df.withColumn("_toks", tokens(text_col))
        mentions = {}
        for a in ASPECTS:
            words = self.aspect_words.get(a, [])
            mentions[f"_m_{a}"] = F.arrays_overlap(toks, F.array(*[F.lit(w) for w in words])) if words else F.lit(False)
        step2 = step1.withColumns({
            "_npos": F.size(F.filter(toks, _member_of(self.positive))),
            "_nneg": F.size(F.filter(toks, _member_of(self.negative))),
            **mentions,
        })
        n_pos, n_neg = F.col("_npos"), F.col("_nneg")
        polarity = F.when(n_pos > n_neg, "POS").when(n_neg > n_pos, "NEG").otherwise("NEU")
        out = []
        for a in ASPECTS:
            mentioned = F.col(f"_m_{a}")
            if a == "General":
                mentioned = mentioned | (n_pos + n_neg > 0)
            out.append(F.when(mentioned, polarity).otherwise("NONE"))
        result = F.when(toks.isNull(), F.lit(None)).otherwise(aspect_map(F.array(*out)))
        return step2.withColumn(self.output, result).drop("_toks", "_npos", "_nneg", *mentions)


def widen(df: DataFrame, map_col: str = "aspect_sentiments", aspects: list[str] = ASPECTS, drop: bool = True) -> DataFrame:
    """One column per aspect from the aspect map, in a single projection."""
    cols = {a: F.col(map_col)[F.lit(a)] for a in aspects}
    out = df.withColumns(cols)
    return out.drop(map_col) if drop else out


# ------------------------------------------------------------------ CNN

# --- fixed values: layer sizes of the model ---
EMBED_DIM = 128
NUM_FILTERS = 192
WINDOW = 5
DENSE = 128
# --- end of fixed values ---


def random_cnn_weights(vocab_size: int, seed: int = 42, n_aspects: int = len(ASPECTS),
                       n_classes: int = len(SENTIMENTS)) -> dict[str, np.ndarray]:
    """Seeded weights with the model's shapes (no trained artefact is shipped)."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (vocab_size, EMBED_DIM)).astype(np.float32)
    emb[PAD_ID] = 0.0  # padding row is zero
    return {
        "embedding": emb,
        "conv_w": rng.normal(0, 0.05, (NUM_FILTERS, EMBED_DIM, WINDOW)).astype(np.float32),
        "conv_b": np.zeros(NUM_FILTERS, np.float32),
        "dense_w": rng.normal(0, 0.05, (DENSE, NUM_FILTERS)).astype(np.float32),
        "dense_b": np.zeros(DENSE, np.float32),
        "heads_w": rng.normal(0, 0.1, (n_aspects, n_classes, DENSE)).astype(np.float32),
        "heads_b": np.zeros((n_aspects, n_classes), np.float32),
    }


class SeededEmbedding:
    """Embedding rows of a seeded model without a table: the row of an id is drawn from (seed, id) when it is
    asked for, so a vocabulary of any size needs no memory. Indexed like the array that it stands for."""

    def __init__(self, seed: int = 42):
        self.seed = seed

    def __getitem__(self, ids) -> np.ndarray:
        own, back = np.unique(np.asarray(ids, np.int64), return_inverse=True)
        with np.errstate(over="ignore"):
            h = (own.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(self.seed)) * np.uint64(0xD6E8FEB86659FD93)
            h = h + np.arange(1, EMBED_DIM // 2 + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # a 64-bit finaliser
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
            h = h ^ (h >> np.uint64(31))
        far = np.sqrt(-2.0 * np.log(((h >> np.uint64(32)).astype(np.float64) + 1.0) / 2.0**32))  # Box-Muller
        turn = (h & np.uint64(0xFFFFFFFF)).astype(np.float64) * (2.0 * np.pi / 2.0**32)
        rows = (0.1 * np.concatenate([far * np.cos(turn), far * np.sin(turn)], axis=1)).astype(np.float32)
        rows[own == PAD_ID] = 0.0  # padding row is zero
        return rows[back].reshape(*np.shape(ids), EMBED_DIM)


def save_weights(weights: dict[str, np.ndarray], path: str) -> None:
    np.savez(path, **weights)


def load_weights(path: str) -> dict[str, np.ndarray]:
    with np.load(path) as z:
        return {k: z[k] for k in z.files}


def cnn_forward(ids: np.ndarray, w: dict[str, np.ndarray], sub_batch: int = 256) -> np.ndarray:
    """ids[B, L] -> class probabilities[B, aspects, classes] (float32)."""
    heads_w, heads_b = w["heads_w"], w["heads_b"]
    out = np.empty((ids.shape[0], heads_w.shape[0], heads_w.shape[1]), np.float32)
    k = w["conv_w"].shape[2]
    conv = w["conv_w"].transpose(2, 1, 0).reshape(-1, w["conv_w"].shape[0])  # [k*E, F]
    half = k // 2
    for s in range(0, ids.shape[0], sub_batch):
        x = w["embedding"][ids[s:s + sub_batch]]                        # [b, L, E]
        x = np.pad(x, ((0, 0), (half, half), (0, 0)))
        win = np.lib.stride_tricks.sliding_window_view(x, k, axis=1)    # [b, L, E, k]
        win = win.transpose(0, 1, 3, 2).reshape(x.shape[0], -1, conv.shape[0])
        # max over all positions; bias and ReLU after it: they keep the order, so each value is the same
        pooled = np.maximum((win @ conv).max(axis=1) + w["conv_b"], 0.0)  # [b, F]
        d = np.maximum(pooled @ w["dense_w"].T + w["dense_b"], 0.0)      # [b, 128]
        logits = np.einsum("bd,acd->bac", d, heads_w) + heads_b         # [b, A, C]
        logits -= logits.max(axis=2, keepdims=True)
        e = np.exp(logits)
        out[s:s + sub_batch] = e / e.sum(axis=2, keepdims=True)
    return out


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary artefact ``{token: id}`` (one JSON object) -> DataFrame(token, id), parsed by an executor."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "MAP<STRING, INT>").alias("m"))
    return whole.select(F.explode("m").alias("token", "id"))


_ARTEFACTS: dict[str, tuple[dict[str, int], dict[str, np.ndarray]]] = {}


def file_digest(path: str) -> str:
    import hashlib

    h = hashlib.sha256()
    with open(path, "rb") as fh:
        for chunk in iter(lambda: fh.read(1 << 20), b""):
            h.update(chunk)
    return h.hexdigest()


def artefact_key(vocab_path: str, weights_path: str) -> str:
    return file_digest(vocab_path) + ":" + file_digest(weights_path)


def load_artefacts(vocab_path: str, weights_path: str,
                   key: str | None = None) -> tuple[dict[str, int], dict[str, np.ndarray]]:
    """Vocabulary + weights, loaded once per worker process and cached by file
    digest (`key`, where the caller has computed it). The cache entry is assigned only after both files loaded completely,
    so a failed load raises every time instead of leaving a half-built model."""
    key = key or artefact_key(vocab_path, weights_path)
    hit = _ARTEFACTS.get(key)
    if hit is not None:
        return hit
    with open(vocab_path, encoding="utf-8") as fh:
        vocab = {str(k): int(v) for k, v in json.load(fh).items()}
    weights = load_weights(weights_path)
    missing = {"embedding", "conv_w", "conv_b", "dense_w", "dense_b", "heads_w", "heads_b"} - set(weights)
    if missing:
        raise ValueError(f"weights file lacks {sorted(missing)}")
    _ARTEFACTS[key] = (vocab, weights)
    return vocab, weights


_INDEXES: dict[int, tuple] = {}


def _resolve(value):
    """Broadcast value -> (vocab, weights): either the artefacts or their paths."""
    return load_artefacts(*value[1:]) if value[0] == "paths" else value


def _vocab_index(vocab: dict[str, int]):
    """pandas Index over the vocabulary tokens (built once per worker per vocabulary)."""
    key = id(vocab)
    hit = _INDEXES.get(key)
    if hit is None or hit[0] is not vocab:
        toks = list(vocab)
        # the entry keeps a reference to `vocab`, so its id cannot be reused while cached
        hit = (vocab, pd.Index(toks), np.array([vocab[t] for t in toks], np.int64),
               vocab.get("<unk>", UNK_ID), vocab.get("<pad>", PAD_ID))
        _INDEXES[key] = hit
    return hit[1:]


def _as_lists(probs: np.ndarray, batch: pa.Array) -> pa.Array:
    """Probabilities [rows, aspects, classes] as nested lists, null where the batch is."""
    n, a, c = probs.shape
    inner = pa.ListArray.from_arrays(pa.array(np.arange(0, n * a * c + 1, c, dtype=np.int32)),
                                     pa.array(probs.reshape(-1), pa.float32()))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * a + 1, a, dtype=np.int32)), inner, mask=batch.is_null())


class CnnScorer(Scorer):
    """CNN inference: JVM tokenises and cuts to ``max_len`` tokens; one Arrow UDF
    maps tokens to ids (broadcast vocabulary) and runs the forward pass; argmax
    and label decode are native expressions."""

    probs_output = "probs"

    def __init__(self, spark: SparkSession, vocab: dict[str, int], weights: dict[str, np.ndarray],
                 max_len: int = HEAD_MAX_LEN, truncate: str = "head", max_vocab: int = 1_000_000):
        if len(vocab) > max_vocab:
            raise ValueError(f"{len(vocab)} entries are too many to broadcast (limit {max_vocab}): use from_vocabulary_df or MappedCnn")
        self.max_len, self.truncate = max_len, truncate
        self._bc = spark.sparkContext.broadcast((vocab, weights))

    @classmethod
    def from_files(cls, spark: SparkSession, vocab_path: str, weights_path: str, max_len: int = HEAD_MAX_LEN,
                   truncate: str = "head") -> CnnScorer:
        """Artefacts on a path every executor can read: only the paths are
        broadcast, with the files' digests; each worker loads the files itself, once."""
        self = cls.__new__(cls)
        self.max_len, self.truncate = max_len, truncate
        key = artefact_key(vocab_path, weights_path)
        load_artefacts(vocab_path, weights_path, key)  # fail fast on the driver
        self._bc = spark.sparkContext.broadcast(("paths", vocab_path, weights_path, key))
        return self

    @classmethod
    def from_vocabulary_df(cls, spark: SparkSession, vocab_df: DataFrame, weights=None, seed: int = 42,
                           max_vocab: int = 1_000_000, **kw) -> CnnScorer:
        n = vocab_df.count()
        if n > max_vocab:  # too large to send: saved to files that the workers map, with equal results
            from ..session import fresh_path
            from .mapped import MappedCnn, save_model

            return MappedCnn(save_model(spark, vocab_df, fresh_path(spark, "cnn", "model"), weights, seed), **kw)
        rows = vocab_df.select("token", "id").collect()  # bounded artefact (checked above)
        vocab = {r.token: int(r.id) for r in rows}
        vocab.setdefault("<pad>", PAD_ID)
        vocab.setdefault("<unk>", UNK_ID)
        if weights is None:
            weights = random_cnn_weights(max(vocab.values()) + 1, seed)
        return cls(spark, vocab, weights, max_vocab=max_vocab, **kw)

    def probabilities(self, toks: Column) -> Column:
        bc, max_len = self._bc, self.max_len

        @F.arrow_udf(T.ArrayType(T.ArrayType(T.FloatType())))
        def cnn_probs(batch: pa.Array) -> pa.Array:
            vocab, weights = _resolve(bc.value)
            index, ids_of, unk, pad_id = _vocab_index(vocab)
            n = len(batch)
            lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.flatten().to_numpy(zero_copy_only=False)          # all tokens of the batch
            pos = index.get_indexer(flat) if len(flat) else np.zeros(0, np.int64)   # vectorised hash lookup
            flat_ids = np.where(pos >= 0, ids_of[np.maximum(pos, 0)], unk)
            ids = np.full((n, max_len), pad_id, np.int64)
            rows = np.repeat(np.arange(n), lengths)
            cols = np.arange(len(flat_ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            ids[rows, cols] = flat_ids
            return _as_lists(cnn_forward(ids, weights) if n else np.zeros((0, 1, 1), np.float32), batch)

        # Marked non-deterministic so a filter on the output never re-runs the model.
        return cnn_probs.asNondeterministic()(toks)

    def score(self, df: DataFrame, text_col: str, keep_probs: bool = False) -> DataFrame:
        with_toks = df.withColumn("_toks", cut(tokens(text_col), self.max_len, self.truncate))
        return self.decided(with_toks.withColumn(self.probs_output, self.probabilities(F.col("_toks"))).drop("_toks"), keep_probs)

    def decided(self, scored: DataFrame, keep_probs: bool) -> DataFrame:
        p = F.col(self.probs_output)
        sent = F.array(*[index_to_sentiment(argmax(p[i])) for i in range(len(ASPECTS))])
        out = scored.withColumn(self.output, F.when(p.isNull(), F.lit(None)).otherwise(aspect_map(sent)))
        return out if keep_probs else out.drop(self.probs_output)


class WholeVocabularyCnn(CnnScorer):
    """The same model with seeded weights for a vocabulary table (token, id) of any size: ids come from
    ``token_ids`` (looked up in the row, or joined beyond ``HELD_VOCAB`` entries). Batch frames only."""

    def __init__(self, spark: SparkSession, vocab_df: DataFrame, seed: int = 42, max_len: int = HEAD_MAX_LEN,
                 truncate: str = "head", max_vocab: int = HELD_VOCAB):
        self.vocab, self.max_len, self.truncate, self.max_vocab = vocab_df, max_len, truncate, max_vocab
        weights = random_cnn_weights(2, seed) | {"embedding": SeededEmbedding(seed)}
        self._bc = spark.sparkContext.broadcast(weights)

    def probabilities(self, ids: Column) -> Column:
        bc, max_len = self._bc, self.max_len

        @F.arrow_udf(T.ArrayType(T.ArrayType(T.FloatType())))
        def cnn_probs(batch: pa.Array) -> pa.Array:
            n = len(batch)
            own = np.full((n, max_len), PAD_ID, np.int64)
            own[batch.is_valid().to_numpy(zero_copy_only=False)] = \
                batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, max_len)
            return _as_lists(cnn_forward(own, bc.value) if n else np.zeros((0, 1, 1), np.float32), batch)

        return cnn_probs.asNondeterministic()(ids)

    def score(self, df: DataFrame, text_col: str, keep_probs: bool = False) -> DataFrame:
        ids = token_ids(df.withColumn("_text", F.col(text_col)), df.columns, "_text", self.vocab, self.max_len, self.truncate,
                        max_vocab=self.max_vocab).withColumnRenamed("ids", "_ids")
        return self.decided(ids.withColumn(self.probs_output, self.probabilities(F.col("_ids"))).drop("_ids"), keep_probs)
