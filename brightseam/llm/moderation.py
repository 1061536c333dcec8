"""Scores for abusive, hateful or sexual language, by a subword-bag classifier trained here."""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from dataclasses import dataclass
from itertools import islice
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dirt import strip
from ..functions.ranking import unit_hash
from ..scratch import Scratch
from .images import table

#: The classes of the labels, the first meaning none.
CLASSES = ("ok", "abuse", "hate", "sexual")
#: Labelled rows used for training at most; a larger table is thinned by a hash of doc_id.
TRAIN_ROWS = 12_000
#: Characters of their texts at most.
TRAIN_CHARS = 30_000_000
#: Hashed features, embedding width, passes over the segments after each relabelling.
BUCKETS, WIDTH, PASSES = 1 << 18, 16, (3, 1, 1, 1, 2, 2)
#: Share of harmless documents that raters call harmful, and of harmful ones they call ok, as the training assumes.
FALSE_ALARM, MISSED = 0.03, 0.08
#: A document is a case from this score on.
THRESHOLD = 0.5
#: Words of one segment at most; a longer run is cut into overlapping windows.
WINDOW, OVERLAP = 40, 10

#: Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
_ALIKE = str.maketrans("аеорсхуіѕԁһјкмтвнοαριντκ", "aeopcxyisdhjkmtbhoapivtk")
_LEET = str.maketrans("013457$!", "oieastsi")
_INVISIBLE = regex.compile(r"[\p{Cf}̀-ͯ͏️]")
_TAG = regex.compile(r"</?[a-zA-Z][^<>]{0,60}>")
_MASK = regex.compile(r"[#*@_%]")
_LATIN, _OTHER = regex.compile(r"\p{Latin}"), regex.compile(r"[\p{Cyrillic}\p{Greek}]")
_WIDE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]")
_FILE_END = re.compile(r"\.(?:jpe?g|png|webp)\b")
_CHUNK = re.compile(r"(?<!\S)[^\s/]*/\S*")


@dataclass(frozen=True)
class _Patterns:
    """Patterns over many segments, one a line."""

    stop: Any  # where a text is cut into segments
    lead: Any  # time and speaker in front of a chat line
    digest: Any
    spaced: Any
    run: Any
    token: Any  # a word, or the end of a line


#: Those of ASCII text are the same, written for the faster module.
_ASCII = _Patterns(
    re.compile(r"[\r\n]+|(?<=[.!?])[\"']*\s+"), re.compile(r"^[^\S\n]*\[\d{1,2}:\d{2}\][^\S\n]*\w{1,6}:[^\S\n]*", re.M), re.compile(r"\b[0-9a-f]{8,}\b"),
    re.compile(r"(?<![\w*])(?:[a-z][ .\-_]{1,2}){2,}[a-z](?![\w*])"), re.compile(r"([a-z])\1{2,}"), re.compile(r"[a-z0-9#*@_$%]+|\n"),
)
_ANY = _Patterns(
    regex.compile(r"[\r\n]+|(?<=[.!?…。！？।؟])[\"'»”)]*\s+|(?<=[。！？])"), regex.compile(r"^[^\S\n]*\[\d{1,2}:\d{2}\][^\S\n]*\w{1,6}:[^\S\n]*", regex.M), regex.compile(r"\b[0-9a-f]{8,}\b"),
    regex.compile(r"(?<![\w*])(?:\p{L}[ .\-_·•]{1,2}){2,}\p{L}(?![\w*])"), regex.compile(r"(\p{L})\1{2,}"), regex.compile(r"[\p{L}\p{M}\p{N}#*@_$%]+|\n"),
)
_JOIN = str.maketrans("", "", " .-_·•")


def segments(text: str | None) -> list[str]:
    """Sentences and lines of a text, without markup; none for NULL or blank."""
    if not text or text.isspace():
        return []
    t = _TAG.sub("\n", html.unescape(text)) if "<" in text or "&" in text else text
    return [s for s in (_ASCII if t.isascii() else _ANY).stop.split(t) if s and not s.isspace()]


def _no_file(m: Any) -> str:
    """A chunk of text with a slash: up to the last ending of an image file it is a file's name."""
    last = None
    for last in _FILE_END.finditer(m[0], m[0].index("/")):
        pass
    return m[0] if last is None else " 0 " + m[0][last.end() :]


def _tokens(lines: list[str], p: _Patterns) -> list[str]:
    """Tokens of all lines, each line but the last followed by a line feed."""
    s = p.lead.sub("", "\n".join(lines)).casefold()
    if "/" in s:
        s = _CHUNK.sub(_no_file, s.replace("copy of ", "copy_of_"))
    s = p.digest.sub(" 0 ", s)
    s = p.spaced.sub(lambda m: m[0].translate(_JOIN), s)
    return p.token.findall(p.run.sub(r"\1", s))


def _word(token: str) -> str:
    """The word a token stands for; empty if none."""
    w = token.lstrip("@")
    if w.isdigit():
        return "0"
    if not w.isascii() and _OTHER.search(w) and _LATIN.search(w):
        w = w.translate(_ALIKE)
    return w if w.isalpha() else _MASK.sub("*", w.translate(_LEET))


def segment_tokens(segs: list[str]) -> tuple[list[int], list[str]]:
    """(order, tokens): tokens of the segments in that order, with line feeds between segments; the tricks of disguise are undone:
    invisible marks, look-alike letters, spaced-out letters, digits for letters, stretched letters.  Masked letters become ``*``; a
    number, a digest or a file's name becomes ``0``.  Many segments are worked on as one text."""
    order: list[int] = []
    tokens: list[str] = []
    for plain in (True, False):
        at = [i for i, s in enumerate(segs) if s.isascii() == plain]
        if not at:
            continue
        lines = [segs[i].replace("\n", " ") for i in at]
        if not plain:
            lines = [unicodedata.normalize("NFC", _INVISIBLE.sub("", unicodedata.normalize("NFD", unicodedata.normalize("NFKC", s)))).replace("\n", " ") for s in lines]
        tokens += (["\n"] if order else []) + _tokens(lines, _ASCII if plain else _ANY)
        order += at
    return order, tokens


def words(segment: str) -> list[str]:
    """The words of one segment."""
    return [w for t in segment_tokens([segment])[1] if (w := _word(t))]


def window_places(start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first place, size) of each window over rows of words at start[i] .. start[i + 1] - 1; none for a row without words."""
    n = np.diff(start)
    step = WINDOW - OVERLAP
    many = np.where(n > WINDOW, -(-(n - OVERLAP) // step), np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), many)
    skip = step * (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
    return row, start[row] + skip, np.minimum(WINDOW, n[row] - skip)


def windows(ws: list[str]) -> list[list[str]]:
    """The windows of one row of words."""
    _, place, n = window_places(np.array([0, len(ws)]))
    return [ws[a : a + k] for a, k in zip(place.tolist(), n.tolist(), strict=True)]


def _hash(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "replace"))


#: Odd numbers that the codes of a gram's characters are multiplied by; any such numbers do.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def word_features(words: list[str], hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all words, how many each has): the word, by its hash, and its character n-grams (2 to 4 in scripts without
    spaces, else 3 and 4)."""
    n = np.array([len(w) + 2 for w in words], np.int64)
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), n)
    left = np.cumsum(n)[owner] - np.arange(len(code))
    wide = np.array([bool(not w.isascii() and _WIDE.search(w)) for w in words], bool)
    owners, found = [np.arange(len(words))], [np.array(hashes, np.uint64)]
    for k in (2, 3, 4):
        at = np.flatnonzero((left >= k) & wide[owner] if k == 2 else left >= k)
        h = np.full(len(at), k, np.uint64)
        for j in range(k):
            h = (h ^ code[at + j]) * _MIX[j]
            h ^= h >> np.uint64(29)
        owners.append(owner[at])
        found.append(h >> np.uint64(7))
    of = np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    return (np.concatenate(found)[order] & np.uint64(BUCKETS - 1)).astype(np.int64), np.bincount(of, minlength=len(words))


class Vocabulary:
    """Words by number; 0 stands before the first word of a window and 1 after the last."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {"^": 0, "$": 1}
        self.of_token: dict[str, int] = {"\n": -1}
        self.hashes = [_hash("w:^"), _hash("w:$")]

    def __len__(self) -> int:
        return len(self.of_token)

    def _number(self, token: str) -> int:
        w = _word(token)
        i = self.ids.get(w, -2) if w else -2
        if w and i < 0:
            i = self.ids[w] = len(self.ids)
            self.hashes.append(_hash("w:" + w))
        self.of_token[token] = i
        return i

    def encode(self, segs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment of each row, word numbers of all rows, first place of each row and the end); a segment is a row."""
        order, tokens = segment_tokens(segs)
        got = [self._number(t) if i is None else i for t, i in zip(tokens, map(self.of_token.get, tokens), strict=True)]
        x = np.array(got, np.int64)
        ends = np.flatnonzero(x == -1)
        kept = np.concatenate(([0], np.cumsum(x >= 0)))
        start = np.concatenate(([0], kept[ends], kept[-1:])) if order else np.zeros(1, np.int64)
        return np.array(order, np.int64), x[x >= 0], start

    def new_words(self, since: int) -> list[str]:
        """Words numbered from ``since`` on."""
        return list(islice(self.ids, since, None))

    def pairs(self, flat: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature of each two words in a row, first place of each row and the end); a row of n words has n + 1."""
        n = np.diff(start)
        left, right = np.insert(flat, start[:-1], 0), np.insert(flat, start[1:], 1)
        h = np.array(self.hashes, np.uint64)
        mixed = h[left] * np.uint64(0x9E3779B1) + h[right] * np.uint64(0x85EBCA77)
        return ((mixed >> np.uint64(17)) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(([0], np.cumsum(n + 1)))


def spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places start[i] .. start[i] + n[i] - 1 of all i in a row."""
    ends = np.cumsum(n)
    return np.repeat(start - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)


def row_features(vocabulary: Vocabulary, flat: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of all rows, first place of each row and the end): those of the words of a row, then of its pairs."""
    table, size = word_features(vocabulary.new_words(2), vocabulary.hashes[2:])
    size = np.concatenate((np.zeros(2, np.int64), size))
    first = np.cumsum(size) - size
    pair, pair_start = vocabulary.pairs(flat, start)
    own = np.add.reduceat(size[flat], start[:-1]) if len(flat) else np.zeros(0, np.int64)
    begin = np.concatenate(([0], np.cumsum(own + np.diff(pair_start))))
    out = np.empty(begin[-1], np.int64)
    out[spread(begin[:-1], own)] = table[spread(first[flat], size[flat])]
    out[spread(begin[:-1] + own, np.diff(pair_start))] = pair
    return out, begin


class SubwordBag:
    """Mean of the embeddings of a segment's features, and a linear softmax on it; both are trained together."""

    def __init__(self, seed: int = 63):
        rng = np.random.default_rng(seed)
        self.e = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
        self.w = np.zeros((WIDTH, len(CLASSES)), np.float32)
        self.b = np.zeros(len(CLASSES), np.float32)
        self.rng = rng
        self.ge, self.gw, self.gb = np.full(BUCKETS, 1e-4, np.float32), np.full_like(self.w, 1e-3), np.full_like(self.b, 1e-3)

    def fit(self, flat: np.ndarray, start: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float = 0.3, batch: int = 256) -> None:
        """One pass.  One row of ``target`` (class shares) and ``weight`` a segment; features of segment i are flat[start[i]:start[i+1]]."""
        ge, gw, gb = self.ge, self.gw, self.gb
        size = np.diff(start)
        use = np.flatnonzero((weight > 0) & (size > 0))
        self.rng.shuffle(use)
        for at in range(0, len(use), batch):
            seg = use[at : at + batch]
            n = size[seg]
            ends = np.cumsum(n)
            idx = np.take(flat, spread(start[seg], n))  # take is much faster than an index in brackets
            h = np.add.reduceat(np.take(self.e, idx, axis=0), ends - n, axis=0) / n[:, None]
            z = h @ self.w + self.b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (p - target[seg]) * weight[seg, None]
            dh = ((g @ self.w.T) / n[:, None]).astype(np.float32)
            dw, db = h.T @ g, g.sum(0)
            keyed = np.sort(idx << 32 | np.arange(len(idx)))  # sorting numbers is faster than sorting places
            sid, order = keyed >> 32, keyed & 0xFFFFFFFF
            first = np.flatnonzero(np.concatenate(([True], sid[1:] != sid[:-1])))
            de = np.add.reduceat(np.take(dh, np.take(np.repeat(np.arange(len(seg)), n), order), axis=0), first, axis=0)
            rows = sid[first]
            ge[rows] += (de**2).mean(1)
            self.e[rows] -= rate * de / np.sqrt(ge[rows])[:, None]
            gw += dw**2
            gb += db**2
            self.w -= rate * dw / np.sqrt(gw)
            self.b -= rate * db / np.sqrt(gb)

    def table(self) -> np.ndarray:
        """Each feature's share in the logits: as the mean is linear, scoring needs nothing else."""
        return (self.e @ self.w).astype(np.float32)


def train(texts: list[str | None], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature logits, bias) from document labels.

    A label speaks of a whole document, while one segment makes the case, and raters err.  A document is harmful if
    any segment is; training alternates between fitting the model and the chance that each segment of a document is
    harmful given the document's label (expectation-maximisation with a noisy or).  So phrases that merely come with
    harmful ones lose their share, since they also stand in harmless documents.  Equal segments are one.
    """
    raw: dict[str, int] = {}
    own_raw = [[raw.setdefault(s, len(raw)) for s in segments(t)] for t in texts]
    vocabulary = Vocabulary()
    segment, flat, start = vocabulary.encode(list(raw))
    ids: dict[bytes, int] = {}
    rows: list[tuple[int, int]] = []
    of_raw: list[list[int]] = [[] for _ in raw]
    for row, at, n in zip(*(x.tolist() for x in window_places(start)), strict=True):
        i = ids.setdefault(flat[at : at + n].tobytes(), len(ids))
        if i == len(rows):
            rows.append((at, n))
        of_raw[segment[row]].append(i)
    doc_segs = [sorted({i for r in own for i in of_raw[r]}) for own in own_raw]
    model = SubwordBag()
    if not ids:  # nothing to learn from: all is ok
        return np.zeros((BUCKETS, len(CLASSES)), np.float32), np.array([20, 0, 0, 0], np.float32)
    places, n = np.array(rows, np.int64).T
    flat, start = row_features(vocabulary, flat[spread(places, n)], np.concatenate(([0], np.cumsum(n))))
    doc = np.repeat(np.arange(len(doc_segs)), [len(s) for s in doc_segs])
    seg = np.array([s for d in doc_segs for s in d], np.int64)
    lab = np.array(labels, np.int64)[doc]
    n_docs, many = len(doc_segs), np.bincount(seg, minlength=len(ids)).astype(np.float64)
    weight = np.minimum(many, 8).astype(np.float32)
    bad = (lab > 0).astype(np.float64)  # chance that the occurrence is harmful
    kind = np.zeros((len(lab), len(CLASSES)))  # which class it then has
    kind[np.arange(len(lab)), lab] = 1
    positive = (np.array(labels) > 0)[doc]
    late: list[tuple[np.ndarray, np.ndarray]] = []  # after each pass of the last two rounds; their mean wavers less than the last one
    for r, passes in enumerate(PASSES):
        target = np.zeros((len(ids), len(CLASSES)))
        np.add.at(target, seg, bad[:, None] * kind)
        target[:, 0] = many - target[:, 1:].sum(1)
        for _ in range(passes):
            model.fit(flat, start, (target / np.maximum(many, 1)[:, None]).astype(np.float32), weight)
            logits = model.table()
            if r >= len(PASSES) - 2:
                late.append((logits, model.b.copy()))
        z = np.empty((len(ids), len(CLASSES)), np.float32)
        for at in range(0, len(ids), 20_000):
            to = min(len(ids), at + 20_000)
            f = flat[start[at] : start[to]]
            z[at:to] = np.add.reduceat(np.take(logits, f, axis=0), start[at:to] - start[at], axis=0) / np.diff(start[at : to + 1])[:, None] + model.b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        q = np.clip(1 - p[seg, 0], 1e-4, 1 - 1e-4)
        clean = np.exp(np.bincount(doc, np.log(1 - q), minlength=n_docs))[doc]
        called = (1 - MISSED) * (1 - clean) + FALSE_ALARM * clean
        bad = np.where(positive, q * (1 - MISSED) / called, q * MISSED / (1 - called))
        other = p[seg][:, 1:] / np.maximum(p[seg][:, 1:].sum(1, keepdims=True), 1e-9)
        kind[~positive, 1:] = other[~positive]
        kind[~positive, 0] = 0
    return np.mean([x for x, _ in late], axis=0, dtype=np.float32), np.mean([b for _, b in late], axis=0, dtype=np.float32)


class Scorer:
    """Class probabilities of each text's worst segment."""

    def __init__(self, logits: np.ndarray, bias: np.ndarray, remember: int = 200_000):
        self.logits, self.bias, self.remember = logits, bias, remember
        self.forget()

    def forget(self) -> None:
        self.vocabulary = Vocabulary()
        self.sums, self.counts = np.zeros((2, len(CLASSES)), np.float32), np.zeros(2, np.int64)
        self.known: dict[str, int] = {}
        self.worst = np.zeros((0, len(CLASSES)), np.float32)

    def _learn(self, segs: list[str]) -> None:
        """Probabilities of segments not met before."""
        segment, flat, start = self.vocabulary.encode(segs)
        new = self.vocabulary.new_words(len(self.counts))
        if new:
            features, n = word_features(new, self.vocabulary.hashes[len(self.counts) :])
            self.sums = np.concatenate((self.sums, np.add.reduceat(np.take(self.logits, features, axis=0), np.cumsum(n) - n, axis=0)))
            self.counts = np.concatenate((self.counts, n))
        row, place, n = window_places(start)
        flat, start, owner = flat[spread(place, n)], np.concatenate(([0], np.cumsum(n))), segment[row]
        p = np.zeros((len(segs), len(CLASSES)), np.float32)
        p[:, 0] = 1
        if len(row):
            pair, pair_start = self.vocabulary.pairs(flat, start)
            z = np.add.reduceat(np.take(self.sums, flat, axis=0), start[:-1], axis=0) + np.add.reduceat(np.take(self.logits, pair, axis=0), pair_start[:-1], axis=0)
            z = z / (np.add.reduceat(np.take(self.counts, flat), start[:-1]) + np.diff(pair_start))[:, None] + self.bias
            q = np.exp(z - z.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            order = np.lexsort((q[:, 0], owner))  # of the windows of a segment the worst comes first
            first, at = np.unique(owner[order], return_index=True)
            p[first] = q[order][at]
        self.known.update(zip(segs, range(len(self.worst), len(self.worst) + len(segs)), strict=True))
        self.worst = np.concatenate((self.worst, p))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """One row a text: its score, then the chance of each harmful class; 0 for a text without words."""
        if len(self.known) > self.remember or len(self.vocabulary) > self.remember:
            self.forget()
        own = [segments(t) for t in texts]
        new = list({s: None for o in own for s in o if s not in self.known})
        if new:
            self._learn(new)
        out = np.zeros((len(texts), len(CLASSES)))
        n = np.array([len(o) for o in own], np.int64)
        if n.sum():
            p = self.worst[[self.known[s] for o in own for s in o]]
            doc = np.repeat(np.arange(len(texts)), n)
            order = np.lexsort((p[:, 0], doc))
            first, at = np.unique(doc[order], return_index=True)
            worst = p[order][at].astype(np.float64)
            out[first, 0], out[first, 1:] = np.maximum(0, 1 - worst[:, 0]), worst[:, 1:]
        return out


def labelled(spark: SparkSession, folder: str, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> tuple[list[str | None], list[int]]:
    """Texts and classes of a sample of the labelled documents: the class most raters gave, of equals the one named first in CLASSES.

    At most about ``rows`` documents and ``chars`` characters: more are thinned by a hash of doc_id, whole documents only; a text of
    more than a hundredth of ``chars`` is not learned from.  Labels that name no class are left out.
    """
    m = table(spark, folder, "moderation_labels").select("doc_id", F.lower(strip(F.col("category"))).alias("c")).where(F.col("c").isin(*CLASSES) & F.col("doc_id").isNotNull())
    votes = m.groupBy("doc_id").agg(*[F.count_if(F.col("c") == c).alias(c) for c in CLASSES])
    named = F.array_position(F.array(*CLASSES), F.greatest(*CLASSES)) - 1
    docs = table(spark, folder, "documents").select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= chars // 100)
    got = votes.select("doc_id", named.cast("int").alias("label"), unit_hash("doc_id", seed=63).alias("u")).join(docs, "doc_id")
    got = Scratch(spark, "labelled").cut(got, "texts")
    n, size = got.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    part = got.where(F.col("u") < min(1.0, rows / max(n, 1), chars / max(size, 1))).orderBy("doc_id").select("text", "label").toArrow()
    return part["text"].to_pylist(), part["label"].to_pylist()


_FITTED: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}


def fitted(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """The model of a folder's labels; queries of one session share it as long as the files of the labels stay the same."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for f in sorted(table(spark, folder, "moderation_labels").inputFiles()):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        status = path.getFileSystem(conf).getFileStatus(path)
        files.append((f, status.getLen(), status.getModificationTime()))
    key = (spark.sparkContext.applicationId, folder, tuple(files))
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = train(*labelled(spark, folder))
    return _FITTED[key]


def score_documents(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, abuse, hate, sexual) of every row; 0 for NULL, empty and blank texts.  The score is that of the worst segment.

    The model (one number for each feature and class, 4 MB whatever the corpus) goes to the executors once.  Texts are scored
    some million characters at a time.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        s = Scorer(*shared.value)
        for b in batches:
            texts, got, at = b.column(1).to_pylist(), [], 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and size < 2_000_000:
                    size += len(texts[stop] or "")
                    stop += 1
                got.append(s.score(texts[at:stop]))
                at = stop
            x = np.concatenate(got) if got else np.zeros((0, len(CLASSES)))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(np.ascontiguousarray(x[:, i]), pa.float64()) for i in range(len(CLASSES))]], [key, "score", *CLASSES[1:]])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(score, f"`{key}` {kind}, score double, abuse double, hate double, sexual double")


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"), fitted(spark, folder))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_scores(spark, folder).where(F.col("score") >= THRESHOLD).select("doc_id")


def source_name(c: Column) -> Column:
    """A source's name however it is written; ``unknown`` for none."""
    name = F.regexp_replace(F.lower(strip(c)), r"[\s-]+", "_")
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("unknown"))


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, cases and their rate of each source, however its name is written."""
    docs = table(spark, folder, "documents").select("doc_id", source_name(F.col("source")).alias("source"))
    scores = Scratch(spark, "scores").cut(p10_scores(spark, folder).select("doc_id", "score"), "scores")
    g = docs.join(scores, "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("score") >= THRESHOLD).alias("cases"))
    return g.withColumn("rate", F.round(F.col("cases") / F.col("documents"), 6))


def p10_check(spark: SparkSession, folder: str) -> DataFrame:
    """(source, documents, odd) of the scores: every document has one from 0 to 1, not less than the chance of any one class, and 0 if it has no text."""
    docs = table(spark, folder, "documents").select("doc_id", source_name(F.col("source")).alias("source"), (F.col("text").isNull() | (F.col("text") == "")).alias("none"))
    j = docs.join(p10_scores(spark, folder), "doc_id", "left")
    good = F.col("score").between(0, 1) & (F.col("score") >= F.greatest("abuse", "hate", "sexual") - 1e-6) & (~F.col("none") | (F.col("score") == 0))
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if(~F.coalesce(good, F.lit(False))).alias("odd"))
