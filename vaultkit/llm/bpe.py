"""BPE encoding and decoding with a minimal acyclic transducer lexicon (operator 4).

The words of all texts are counted; at most ``LEXICON`` of the most frequent and their token ids are
compiled into a minimal acyclic automaton (states with equal futures are shared, edges carry outputs
whose sum is the word's row in the id table). The automaton goes to the executors as one file, which
every task maps into memory. Words outside it are merged exactly, by rank, many words at once. The
lexicon only saves time: the ids are the same with any lexicon.

The vocabulary file follows the tokenizers JSON format (byte-level BPE with an end-of-word suffix);
its path is a parameter. Special tokens written in a text are one id each, as in the library.

Defined cases: a null text counts as empty and has no ids; repeated rows give repeated rows; an
empty table gives no rows; other columns are ignored; a word of any length is merged whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import land, segments, share, shared_folder, shared_value, slices, table, tasks

VOCABULARY = "word_bpe_49k.json"
LEXICON = 65_536           # words of the automaton
LOCAL = 2 * LEXICON        # words that a task reports at most
PRUNE = 400_000            # counters a task keeps before it drops the rarer half
SLICE = 1_000_000
LONG = 48                  # bytes of a word from which it is merged by a heap

_SPACE = r"\t-\r \x85\xa0  -     　"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


def letters_of(category: str, top: int) -> str:
    """The ranges of a regular expression's class for all characters of a Unicode category below ``top``."""
    has = np.array([unicodedata.category(chr(c))[0] == category for c in range(top)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], has, [False]]).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


class Vocabulary:
    """Ids, merge ranks and token strings of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        ids, suffix = j["model"]["vocab"], j["model"]["end_of_word_suffix"]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        strings = {i: t for t, i in [*ids.items(), *self.special.items()]}
        self.strings = [strings.get(i, "") for i in range(max(strings) + 1)]
        self.inner = np.array([ids[c] for c in letters], np.int64)          # id of a byte inside a word
        self.last = np.array([ids[c + suffix] for c in letters], np.int64)  # and at its end
        merges = [m if isinstance(m, list) else m.split(" ") for m in j["model"]["merges"]]
        keys = np.array([(ids[a] << 20) | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        _, first = np.unique(keys, return_index=True)
        self.keys, self.ranks, self.made = keys[first], first, made[first]
        split = next(p for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        split = split.replace(r"\s", _SPACE)
        # Characters beyond 16 bits slow a class down; texts without them take the short pattern.
        self.patterns = [split.replace(r"\p{L}", letters_of("L", n)).replace(r"\p{N}", letters_of("N", n)) for n in (0x10000, 0x110000)]

    def rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair; pairs that do not merge have the largest rank."""
        key = (a << 20) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(ok, self.ranks[at], 1 << 40), np.where(ok, self.made[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, flat ids) per word: merges in order of rank, leftmost first."""
        starts, lens, flat, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        for n, at in by.items():
            at = np.array(at)
            if n > LONG:
                done = [(at[k:k + 1], self._merge_long(words[i])[None]) for k, i in enumerate(at.tolist())]
            elif n:
                m = np.frombuffer(b"".join([words[i] for i in at.tolist()]), np.uint8).reshape(len(at), n)
                ids = self.inner[m]
                ids[:, -1] = self.last[m[:, -1]]
                done = self._merge_equal(at, ids)
            else:
                done = []
            for rows, ids in done:
                starts[rows] = total + np.arange(len(rows)) * ids.shape[1]
                lens[rows] = ids.shape[1]
                flat.append(ids.ravel())
                total += ids.size
        return starts, lens, np.concatenate(flat) if flat else np.empty(0, np.int64)

    def _merge_equal(self, rows: np.ndarray, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Words of one length; each round merges one pair in each word that still has one."""
        done = []
        if ids.shape[1] > 1:
            rank, made = self.rank(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1 and len(rows):
            best = rank.argmin(1)
            each = np.arange(len(rows))
            more = rank[each, best] < 1 << 40
            if not more.all():
                done.append((rows[~more], ids[~more]))
                ids, rank, made, best, rows = ids[more], rank[more], made[more], best[more], rows[more]
                each = each[:len(rows)]
                if not len(rows):
                    break
            ids[each, best] = made[each, best]
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > best[:, None]), 1)       # drop the right half of the pair
            if ids.shape[1] == 1:
                break
            cols = cols[:-1]
            step = cols + (cols >= best[:, None])
            rank, made = np.take_along_axis(rank, step, 1), np.take_along_axis(made, step, 1)
            for side in (best - 1, best):                                          # the two pairs with the new token
                ok = (side >= 0) & (side < ids.shape[1] - 1)
                r, s = each[ok], side[ok]
                rank[r, s], made[r, s] = self.rank(ids[r, s], ids[r, s + 1])
        return [*done, (rows, ids)]

    def _merge_long(self, word: bytes) -> np.ndarray:
        b = np.frombuffer(word, np.uint8)
        ids = self.inner[b].tolist()
        ids[-1] = int(self.last[b[-1]])
        nxt, prv = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        table_ = self._pairs()
        heap = [(*table_[k], i, k) for i in range(len(ids) - 1) if (k := (ids[i] << 20) | ids[i + 1]) in table_]
        heap = [(r, i, k, m) for r, m, i, k in heap]
        heapq.heapify(heap)
        while heap:
            _, i, k, made = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] < 0 or j >= len(ids) or (ids[i] << 20) | ids[j] != k:
                continue
            ids[i], ids[j], nxt[i] = made, -1, nxt[j]
            if nxt[i] < len(ids):
                prv[nxt[i]] = i
            for left in (prv[i], i):
                if left >= 0 and nxt[left] < len(ids) and (k := (ids[left] << 20) | ids[nxt[left]]) in table_:
                    r, m = table_[k]
                    heapq.heappush(heap, (r, left, k, m))
        return np.array([x for x in ids if x >= 0], np.int64)

    def _pairs(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_table"):
            self._table = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        return self._table


class Splitter:
    """Tokens between white space, normalised, and their words. A special token has a blank before it."""

    def __init__(self, vocabulary: Vocabulary):
        self.short, self.full = [re.compile(p).findall for p in vocabulary.patterns]
        self.odd = re.compile("[\x1c-\x1f]").search        # white space for split() only
        self.blank = re.compile(f"[{_SPACE}]+")
        self.special = vocabulary.special
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.marks = {t[:2] for t in self.special}

    def tokens(self, text: bytes | None) -> list[str]:
        if not text:
            return []
        t = text.decode("utf-8", "replace")
        if not any(m in t for m in self.marks):
            return self._tokens(t)
        out = []
        for part in self.cut.split(t):
            out += [" " + part] if part in self.special else self._tokens(part)
        return out

    def _tokens(self, t: str) -> list[str]:
        if not t.isascii():
            t = unicodedata.normalize("NFC", t).replace("Σ", "σ")   # no special case for a last sigma
        t = t.lower()
        return t.split() if not self.odd(t) else [x for x in self.blank.split(t) if x]

    def words(self, token: str) -> list[str]:
        if token[0] == " ":
            return [token]
        if token.isascii():
            return [token] if token.isalpha() else self.short(token)
        return (self.short if max(token) < "\U00010000" else self.full)(token)


# --- the automaton -------------------------------------------------------------------------------

def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Edges and final flags of the minimal acyclic automaton of sorted distinct words; state 0 starts.

    States are added along each word and, once no later word can change them, replaced by an equal
    earlier state if there is one.
    """
    edges: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]                       # states of the last word that may still change
    last = b""

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            s = path.pop()
            key = (final[s], tuple(edges[s].items()))
            same = known.setdefault(key, s)
            if same != s:
                edges[path[-1]][last[len(path) - 1]] = same

    for w in words:
        k = 0
        while k < min(len(w), len(last)) and w[k] == last[k]:
            k += 1
        freeze(k)
        for b in w[k:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][b] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = w
    freeze(0)
    return edges, final


def compile_lexicon(words: list[bytes], vocab: Vocabulary) -> bytes:
    """The transducer of sorted ``words`` with their ids as outputs, as one int32 array."""
    at, lens, ids = vocab.merge(words)
    edges, final = minimal_automaton(words)
    order, seen = [], set()
    stack = [(0, False)]
    while stack:                     # states after all states they lead to
        s, out = stack.pop()
        if out:
            order.append(s)
        elif s not in seen:
            seen.add(s)
            stack.append((s, True))
            stack += [(t, False) for t in edges[s].values() if t not in seen]
    count = {}
    for s in order:
        count[s] = int(final[s]) + sum(count[t] for t in edges[s].values())
    number = {s: i for i, s in enumerate(sorted(seen))}
    n = len(number)
    base, flag = np.zeros(n, np.int32), np.zeros(n, np.int32)
    used, owner, target, out = bytearray(1 << 16), [], [], []
    start: dict[int, int] = {}       # by number of edges: where the last such state found room
    slots = {}
    for s in sorted(seen, key=lambda s: -len(edges[s])):
        flag[number[s]] = final[s]
        labels = sorted(edges[s])
        if not labels:
            continue
        b = start.get(len(labels), 0)
        while True:
            if b + 256 >= len(used):
                used.extend(bytes(len(used)))
            if not any(used[b + c] for c in labels):
                break
            b += 1
        start[len(labels)] = b
        base[number[s]] = b
        total = int(final[s])
        for c in labels:
            used[b + c] = 1
            slots[b + c] = number[s] + 1, number[edges[s][c]], total
            total += count[edges[s][c]]
    size = max(slots, default=0) + 257
    owner, target, out = np.zeros(size, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32)
    for k, (o, t, w) in slots.items():
        owner[k], target[k], out[k] = o, t, w
    starts = segments(lens)
    flat = ids[np.arange(starts[-1]) + np.repeat(at - starts[:-1], lens)].astype(np.int32)
    starts = starts.astype(np.int32)
    return np.concatenate([np.array([n, size, len(words), len(flat)], np.int32), base, flag, owner, target, out, starts, flat]).tobytes()


class Lexicon:
    """The transducer, mapped from its file."""

    def __init__(self, path: str):
        a = np.memmap(path, np.int32, "r")
        n, size, words, flat = (int(x) for x in a[:4])
        cuts = np.cumsum([4, n, n, size, size, size, words + 1, flat])
        self.base, self.final, self.owner, self.target, self.out, self.starts, self.flat = (a[x:y] for x, y in zip(cuts, cuts[1:]))
        self.empty = words == 0

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Row of each word in the id table, or -1; all words step together."""
        lens = np.array([len(w) for w in words], np.int64)
        row = np.full(len(words), -1, np.int64)
        if self.empty or not len(words):
            return row
        text, at = np.frombuffer(b"".join(words), np.uint8), segments(lens)[:-1]
        live = np.flatnonzero((lens > 0) & (lens <= LONG))
        state, out = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        k = 0
        while len(live):
            slot = self.base[state] + text[at[live] + k].astype(np.int64)
            ok = self.owner[slot] == state + 1
            live, slot, out = live[ok], slot[ok], out[ok]
            state, out = self.target[slot].astype(np.int64), out + self.out[slot]
            k += 1
            end = lens[live] == k
            hit = end & (self.final[state] == 1)
            row[live[hit]] = out[hit]
            live, state, out = live[~end], state[~end], out[~end]
        return row


# --- Spark ---------------------------------------------------------------------------------------

def _count_words(vocabulary):
    def run(batches):
        split, counts = Splitter(shared_value(vocabulary)), Counter()
        for b in batches:
            for _, part in slices(b.column(0), SLICE):
                for t in part:
                    counts.update(split.tokens(t))
                if len(counts) > PRUNE:
                    counts = Counter(dict(counts.most_common(PRUNE // 2)))
        words: Counter = Counter()
        for token, n in counts.items():
            for w in split.words(token):
                words[w] += n
        top = words.most_common(LOCAL)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"])
    return run


def frequent_words(docs: DataFrame, vocabulary, text: str = "text", limit: int = LEXICON) -> list[str]:
    """The lexicon's words: counted over all texts, at most ``limit`` of the most frequent ones.

    A histogram of the counts (logarithmic bins, some hundred rows) gives the least count for which
    no more than ``limit`` words are left; only those words come to the driver.
    """
    counts = tasks(docs.select(text), _count_words(vocabulary), "word string, n long")
    counts = land(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    bin_ = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for r in counts.groupBy(bin_.alias("b")).agg(F.count("*").alias("words")).orderBy(F.desc("b")).collect():
        total += r.words
        if total > limit:
            break
        least = r.b
    return [] if least is None else sorted(r.word for r in counts.where(bin_ >= least).select("word").collect())


def _encode(vocabulary, lexicon: str, fields: list[str]):
    def run(batches):
        vocab = shared_value(vocabulary)
        split, lex = Splitter(vocab), Lexicon(SparkFiles.get(lexicon))
        for b in batches:
            docs = b.column(0)
            for first, part in slices(b.column(1), SLICE):
                texts = [split.tokens(t) for t in part]
                index: dict[str, int] = {}
                for ts in texts:
                    index.update(dict.fromkeys(ts))
                for i, t in enumerate(index):
                    index[t] = i
                starts, lens, flat = ids_of(list(index), split, vocab, lex)
                out = []
                for ts in texts:
                    k = np.fromiter(map(index.__getitem__, ts), np.int64, len(ts))
                    ids = expand(starts[k], lens[k], flat).astype("<u4")
                    total = len(ids)
                    row = {"n_tokens": total, "ids": ids.tobytes()}
                    row["ids_sha256"] = hashlib.sha256(row["ids"]).hexdigest()
                    decoded = decode(ids, vocab)
                    row["decoded"] = decoded
                    row["decoded_sha256"] = hashlib.sha256(decoded.encode()).hexdigest()
                    out.append([row[f] for f in fields])
                cols = list(zip(*out)) if out else [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(first, len(part)), *[pa.array(c, _KIND[f]) for c, f in zip(cols, fields)]], names=["doc_id", *fields])
    return run


def expand(starts: np.ndarray, lens: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The runs [start, start + length) of ``flat``, one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lens), lens)]


def ids_of(tokens: list[str], split: Splitter, vocab: Vocabulary, lex: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, flat ids) per token between white space: its words' ids, one after the other."""
    parts = [split.words(t) for t in tokens]
    index: dict[str, int] = {}
    for p in parts:
        for w in p:
            index.setdefault(w, len(index))
    starts, lens, flat = word_ids(list(index), vocab, lex)
    of = np.fromiter((index[w] for p in parts for w in p), np.int64)
    flat = expand(starts[of], lens[of], flat)
    ends = segments(lens[of])[segments(np.fromiter(map(len, parts), np.int64, len(parts)))]
    return ends[:-1], np.diff(ends), flat


def word_ids(words: list[str], vocab: Vocabulary, lex: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, flat ids) per word: from the lexicon, else by merging; specials have their id."""
    raw = [w.encode() for w in words]
    row = lex.rows(raw)
    starts, lens = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    known = np.flatnonzero(row >= 0)
    starts[known] = lex.starts[row[known]]
    lens[known] = lex.starts[row[known] + 1] - starts[known]
    unseen = np.flatnonzero(row < 0).tolist()
    special = [i for i in unseen if words[i].startswith(" ")]
    rest = [i for i in unseen if not words[i].startswith(" ")]
    at, n, merged = vocab.merge([raw[i] for i in rest])
    starts[rest], lens[rest] = len(lex.flat) + at, n
    starts[special], lens[special] = len(lex.flat) + len(merged) + np.arange(len(special)), 1
    own = np.array([vocab.special[words[i][1:]] for i in special], np.int64)
    return starts, lens, np.concatenate([lex.flat, merged, own]).astype(np.int64)


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    """Token strings with a blank between: what the library gives for a vocabulary file without decoder."""
    return " ".join(map(vocab.strings.__getitem__, ids.tolist()))


_KIND = {"n_tokens": pa.int64(), "ids": pa.binary(), "ids_sha256": pa.string(), "decoded": pa.string(), "decoded_sha256": pa.string()}
_SQL = {"n_tokens": "long", "ids": "binary", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def ship_lexicon(spark, words: list[str], vocab: Vocabulary) -> str:
    """Compile ``words`` into a file of the shared folder, which Spark copies to every executor, later ones included."""
    raw = sorted(w.encode() for w in words if not w.startswith(" "))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.write(compile_lexicon(raw, vocab))
    out.close()
    fs.deleteOnExit(path)
    sc.addFile(path.toString())
    return name


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
           fields: tuple = ("n_tokens", "ids", "decoded"), lexicon: int = LEXICON) -> DataFrame:
    """(doc_id, *fields): ids as little-endian 32-bit integers, the text they decode to, counts and digests."""
    spark = docs.sparkSession
    vocab = Vocabulary(path or vocabulary_path())
    shared = share(spark, vocab)
    name = ship_lexicon(spark, frequent_words(docs, shared, text, lexicon), vocab)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return tasks(src, _encode(shared, name, list(fields)), ", ".join(["doc_id long", *[f"{f} {_SQL[f]}" for f in fields]]))


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), fields=("n_tokens", "ids_sha256", "decoded_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the token ids of every document that is left, with their digests."""
    return encode(docs, fields=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))
