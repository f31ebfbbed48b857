"""Text scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes long, with the counts of what followed
them in the training texts; the counts of a shorter context say after how many different longer
ones a symbol was seen. A symbol not seen after a context is reached by an escape to the next shorter
one: every symbol seen gives half a count to the escape, and symbols of the longer context are
excluded from the shorter one's counts. Below order 0 all remaining symbols are alike.
The trie is fixed while texts are scored, so a symbol's probability depends on its last ``ORDER``
bytes alone, and what the longer context excludes from a shorter one is one number per context:
every level is a sum and a join over the cluster, and the trie is never held in one place.

Documents form blocks of about equal size, at most some ``BLOCK_BYTES`` bytes: stretches of the input's bytes, files one
after the other and the rows of a file in the order of a hash. Every block is a task of its own. A block sends the distinct words and byte runs it holds, once, and
gets back their counts and probabilities; its texts are scored with those. Words that no other block
holds are not sent back, as the block's own count is all there is.

A text is its lower-cased (A-Z) UTF-8 bytes and an end symbol; contexts at its start are filled with
a byte that no text holds. Defined cases: a null text is empty and scored for its end alone; null
ids count as the empty text when training documents are chosen, repeated rows each count; with no
training text all symbols are alike and the base score is 0. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.llm.common import hashed_words, text_batches, write_once

ORDER = 4
BLOCK_BYTES = 32 << 20
SLICE_BYTES = 1 << 19
_PAD, _STOP = 0xFF, 0xFE  # neither occurs in UTF-8
_SYMBOLS = 255  # all bytes but the filling one
_LOWER = bytes(i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))
_WORD, _RUN, _OWN = 0, 1, 2  # _OWN: a word that one block alone holds


def runs(texts: list, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol with its context as one number (``order + 1`` bytes), and where each text begins."""
    plain = [t.encode("utf-8", "replace").translate(_LOWER) if t else b"" for t in texts]
    head, tail = bytes([_PAD]) * order, bytes([_STOP])
    data = np.frombuffer(b"".join(head + p + tail for p in plain), np.uint8)
    keys = np.zeros(max(0, len(data) - order), np.uint64)
    for k in range(order + 1):
        keys = (keys << np.uint64(8)) | data[k:len(data) - order + k]
    keys = keys[data[order:] != _PAD].view(np.int64)
    return keys, np.cumsum([0, *(len(p) + 1 for p in plain)])


def _slices(sizes: list):
    """Runs of texts of about ``SLICE_BYTES`` together, from the sizes of the texts."""
    i = 0
    while i < len(sizes):
        j, n = i, 0
        while j < len(sizes) and (j == i or n < SLICE_BYTES):
            n += sizes[j]
            j += 1
        yield i, j
        i = j


def _counted(keys: np.ndarray, offsets: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how often the training texts among those that ``offsets`` bound hold them."""
    own, where = np.unique(keys.view(np.int64), return_inverse=True)
    return own, np.bincount(where, np.repeat(train, np.diff(offsets)), len(own)).astype(np.int64)


def _summed(found: list) -> tuple[np.ndarray, np.ndarray]:
    own, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return own, np.bincount(where, np.concatenate([c for _, c in found]), len(own)).astype(np.int64)


def _add(found: list, part: tuple) -> None:
    """Put counts on a stack whose entries at least halve upwards, so a key is merged a few times only."""
    found.append(part)
    while len(found) > 1 and len(found[-2][0]) < 2 * len(found[-1][0]):
        found[-2:] = [_summed(found[-2:])]


def _tail(key: str, order: int) -> Column:
    """The last ``order + 1`` bytes of a run: a shorter context and the symbol."""
    return F.col(key).bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))


def _context(key: str) -> Column:
    return F.shiftright(key, 8)


def trie(counts: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """For each order its symbols (``key``, ``n``) and contexts (``ctx``, ``t``, ``q``, ``t_less``, ``q_less``).

    ``t`` and ``q`` are the total and the number of symbols of a context; ``t_less`` and ``q_less``
    are those of the next shorter context without the symbols seen here.
    """
    symbols = [counts]
    for k in range(order - 1, -1, -1):
        longer = symbols[0]
        symbols.insert(0, write_once(longer.groupBy(_tail("key", k).alias("key")).agg(F.count("*").alias("n")), "symbols"))
    out = []
    for k in range(order + 1):
        own = symbols[k].groupBy(_context("key").alias("ctx")).agg(F.sum("n").alias("t"), F.count("*").alias("q"))
        if k:
            shorter = symbols[k - 1].select(F.col("key").alias("less"), F.col("n").alias("m"))
            shared = (symbols[k].withColumn("less", _tail("key", k - 1)).join(shorter, "less")
                      .groupBy(_context("key").alias("ctx")).agg(F.sum("m").alias("m")))
            above = out[-1][1].select(F.col("ctx").alias("up"), F.col("t").alias("up_t"), F.col("q").alias("up_q"))
            own = (own.join(shared, "ctx").withColumn("up", F.col("ctx").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
                   .join(above, "up").select("ctx", "t", "q", (F.col("up_t") - F.col("m")).alias("t_less"),
                                             (F.col("up_q") - F.col("q")).alias("q_less")))
        else:
            own = own.select("ctx", "t", "q", (F.lit(0) * F.col("t")).alias("t_less"), (F.lit(_SYMBOLS) - F.col("q")).alias("q_less"))
        out.append((symbols[k], write_once(own, "contexts")))
    return out


def probabilities(keys: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``key``, ``lp``: log10 probability of every distinct run; those not found go down one order at a time."""
    # ``t``, ``q``: total and symbols of the context now looked at, after exclusion; null before any was seen.
    rest = keys.select("key", F.lit(0.0).alias("lp"), F.lit(None).cast("long").alias("t"), F.lit(None).cast("long").alias("q"))
    done = []
    for k in range(len(levels) - 1, -1, -1):
        symbols, contexts = levels[k]
        at = rest.withColumn("own", _tail("key", k)).withColumn("ctx", _context("own"))
        at = at.join(contexts.withColumnsRenamed({"t": "t0", "q": "q0"}), "ctx", "left")
        at = at.join(symbols.select(F.col("key").alias("own"), "n"), "own", "left")
        t, q = F.coalesce("t", "t0"), F.coalesce("q", "q0")
        found = F.col("lp") + F.log10((F.col("n") - 0.5) / t)
        fallen = F.when(q > 0, F.col("lp") + F.log10(0.5 * q / t)).otherwise(F.col("lp"))
        at = write_once(at.select("key", "n", F.when(F.col("n").isNotNull(), found).otherwise(fallen).alias("lp"),
                                  F.col("t_less").alias("t"), F.col("q_less").alias("q")), f"order-{k}")
        done.append(at.where("n is not null").select("key", "lp"))
        rest = at.where("n is null").select("key", "lp", "t", "q")
    left = F.greatest(F.coalesce("q", F.lit(_SYMBOLS)), F.lit(1))  # symbols never seen at all share the rest
    out = rest.select("key", (F.col("lp") - F.log10(left)).alias("lp"))
    for part in done:
        out = out.unionAll(part)
    return out


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document; the model and the base learn from the rows where ``held_out`` is false.

    ``base_score`` is the smoothed unigram log10 probability of the words and an end, ``score`` the
    model's log10 probability of the text, ``n_known`` the tokens that occur in training.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), held_out.alias("held_out"))
    rows = rows.withColumn("file", F.xxhash64(F.input_file_name()))
    files = write_once(rows.groupBy("file").agg(F.sum(F.octet_length("text") + F.lit(64)).alias("b"),
                                                F.sum((~F.col("held_out")).cast("long")).alias("train")), "files")
    size = files.agg(F.sum("b").alias("b"), F.sum("train").alias("train")).first()
    blocks = max(1, -(-(size["b"] or 0) // block_bytes))
    train_docs = size["train"] or 0
    before = F.sum("b").over(Window.orderBy("file")) - F.col("b")  # one row per input file
    places = files.select("file", "b", before.alias("start"))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    at = (F.col("start") + share * F.col("b")) * (blocks / (size["b"] or 1))
    rows = rows.join(places, "file").select("doc_id", "text", "held_out",
                                            F.least(F.floor(at), F.lit(blocks - 1)).cast("int").alias("block"))

    def keys_of(kind: int, texts: list) -> tuple[np.ndarray, np.ndarray]:
        return hashed_words(texts) if kind == _WORD else runs(texts, order)

    def gather(batches):
        """Distinct keys of the blocks a task meets, sent on whenever a block's worth of text was read."""
        waiting: dict = {}  # texts of a block that do not fill a slice yet
        held: dict = {}
        read = 0

        def count(block):
            texts, train, _ = waiting.pop(block)
            train = np.concatenate(train)
            for i, j in _slices(list(map(len, texts))):
                for kind in (_WORD, _RUN):
                    _add(held.setdefault((block, kind), []), _counted(*keys_of(kind, texts[i:j]), train[i:j]))

        def send():
            for block in list(waiting):
                count(block)
            for block, kind in list(held):
                own, n = _summed(held.pop((block, kind)))
                yield pd.DataFrame({"block": np.int32(block), "kind": np.int32(kind), "key": own, "n": n})

        for batch in batches:
            for block, part in batch.groupby("block", sort=False):
                texts = part["text"].tolist()
                size = sum(map(len, texts))
                before, train, n = waiting.get(block, ([], [], 0))
                waiting[block] = before + texts, [*train, ~part["held_out"].to_numpy(bool)], n + size
                read += size
                if n + size >= SLICE_BYTES:
                    count(block)
            if read > 2 * block_bytes:
                yield from send()
                read = 0
        yield from send()

    sightings = rows.mapInPandas(gather, "block int, kind int, key long, n long")
    whole = Window.partitionBy("kind", "key")  # one row per block and task that holds the key, at most
    named = sightings.select("block", "kind", "key", F.sum("n").over(whole).alias("n"),
                             (F.min("block").over(whole) == F.max("block").over(whole)).alias("alone"))
    alone = F.col("alone") & (F.col("kind") == _WORD)
    held = write_once(named.select("block", F.when(alone, _OWN).otherwise(F.col("kind")).alias("kind"), "key", "n"), "keys")
    # A block's tasks may each have sent a key; a key that stands alone is then there more than once.
    words = held.where(F.col("kind") != _RUN).groupBy("key").agg(F.max("n").alias("n"))
    tokens = words.where("n > 0").agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_train, distinct = (tokens["n"] or 0) + train_docs, tokens["v"] + (train_docs > 0)
    run_counts = write_once(held.where(F.col("kind") == _RUN).groupBy("key").agg(F.max("n").alias("n")), "run-counts")
    chances = probabilities(run_counts.select("key"), trie(run_counts.where("n > 0"), order))
    sent = (held.where(F.col("kind") == _WORD).select("block", "kind", "key", F.col("n").cast("double").alias("x"))
            .unionAll(held.where(F.col("kind") == _RUN).join(chances, "key").select("block", "kind", "key", F.col("lp").alias("x"))))
    floor = n_train + 0.5 * (distinct + 1)

    def judge(part: pa.Table, known: pa.Table) -> pa.Table:
        """Scores of a block's texts; only a slice of them is taken out of Arrow at a time."""
        texts, train = part["text"], ~part["held_out"].to_numpy()
        sizes = pc.binary_length(texts).to_pylist()
        kinds, keys, values = (known[c].to_numpy() for c in ("kind", "key", "x"))
        tables = {}
        for kind in (_WORD, _RUN):
            own, at = np.unique(keys[kinds == kind], return_index=True)
            tables[kind] = pd.Index(own), values[kinds == kind][at]
        del kinds, keys, values

        def sliced():
            for i, j in _slices(sizes):
                yield i, j, texts.slice(i, j - i).to_pylist()

        found: list = []
        for i, j, some in sliced():
            _add(found, _counted(*keys_of(_WORD, some), train[i:j]))
        mine, n = _summed(found)
        at = tables[_WORD][0].get_indexer(mine)
        tables[_WORD] = pd.Index(mine), np.where(at >= 0, np.append(tables[_WORD][1], 0.0)[at], n)

        def found_in(kind, some):
            keys, offsets = keys_of(kind, some)
            index, x = tables[kind]
            return (x[index.get_indexer(keys.view(np.int64))] if len(keys) else np.zeros(0)), offsets

        def sums(v, offsets):
            total = np.concatenate([[0.0], np.cumsum(v)])
            return total[offsets[1:]] - total[offsets[:-1]]

        out = []
        for _, _, some in sliced():
            c, offsets = found_in(_WORD, some)
            base = sums(np.log10((c + 0.5) / floor), offsets) + np.log10((train_docs + 0.5) / floor)
            n_known = sums((c > 0).astype(float), offsets) + (train_docs > 0)
            out.append((np.diff(offsets) + 1, np.rint(n_known).astype(np.int64), base, sums(*found_in(_RUN, some))))
        n_tokens, n_known, base, total = map(np.concatenate, zip(*out))
        return pa.table({"doc_id": part["doc_id"], "held_out": part["held_out"], "n_tokens": n_tokens,
                         "n_known": n_known, "base_score": base, "score": total,
                         "train_tokens": np.full(len(total), n_train, np.int64)})

    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
              "train_tokens long")
    own, known = (df.repartitionById(blocks, F.col("block")).groupBy("block") for df in (rows, sent))
    judged = own.cogroup(known).applyInArrow(judge, schema)
    return judged.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
