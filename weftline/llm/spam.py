"""Keyword-stuffed, link-list and tag-list mails: bagged decision trees on weak labels, smoothed by host rates.

Weak labels come from a few precise signals, each far out on one or two features. They leave the middle open: most spam
and many ordinary mails get no label. Trees are grown on a bounded sample of the labelled rows, as many of each signal, and
score every mail; nothing overrules them but the rate of the sender's host.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.mail import own_content
from weftline.plans.runtime import settle, ship

FEATURES = ("words", "link_share", "links_per_line", "tag_share", "function_share", "sentence_share", "digit_share", "type_ratio", "top_share", "separators", "chunk_words", "log_share", "upper_share", "lines", "links", "tags")
#: Common words of sentences in the archive's main languages.
FUNCTION_WORDS = frozenset(
    "the a an and or of to in is are was were be been not no but if that this it we you i he she they our your my for on at by with from as so than will can could would should has have had do does did there which who what when where because although until before after still only also"
    " der die das und oder ein eine einen nicht kein keine ist sind war wir ich sie er es den dem des zu zum zur in im mit auf für von bei noch bitte haben habe hat wird werden an als auch nur bis um mir ihnen"
    " le la les un une des et ou de du que qui ne pas est sont nous vous je il elle on au aux en pour par sur avec dans ce cette il faudra sera a été ai avons votre notre me plus"
    " el los las uno una y o de del que no es son está hay nosotros yo se al en para por con sobre su sus ha hemos he le me este esta todavía hasta ningún lo".split()
)
#: A scheme, also one that is written so as not to be a link (h**p, h__p and the like), or www.
LINK = re.compile(r"(?:\b[a-z]{3,5}://|\bh\S\Sps?[:\s]|\bwww\.)\S*", re.I)
WORD = re.compile(r"[^\W\d_]+")
NUMBER = re.compile(r"\d+")
#: Hash tags, words in square brackets, and article numbers.
TAGGED = re.compile(r"#\w+|\[[^\[\]\n]{1,40}\]|\b[A-Z]{2,5}-?[0-9]{3,}\b")
LOG_LINE = re.compile(r"^\W*\d{4}-\d\d-\d\d[ T]\d\d:\d\d|^\W*\[?\d\d:\d\d:\d\d|\b(?:ERROR|WARN|INFO|DEBUG)\b")
END = re.compile(r"[.!?。…؟।]+[\"»”)]*(?:\s+|$)|[。؟।]")
SEPARATOR = re.compile(r"[,;|*•·/]|\s{3,}")
WIDE_SCRIPT = re.compile("[\u0590-\u0dff\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\u0400-\u04ff\u0370-\u03ff]")
#: Bound of the training sample, by signal.
SAMPLE_PER_SIGNAL = 1500
#: The signals of weak labels: those from FIRST_SPAM on mean spam, the others none.
SIGNALS = ("note", "prose", "sentences", "talk", "log", "numbers", "links", "tags", "repeats", "items")
FIRST_SPAM = SIGNALS.index("links")


def is_sentence(part: str) -> bool:
    """Whether the words before a full stop read as a sentence: four or more, not all capitals or a list, with a common
    word in them or letters outside ASCII."""
    words = part.split()
    if WIDE_SCRIPT.search(part):
        return True
    if len(words) < 4 or part.isupper() or len(SEPARATOR.findall(part)) * 3 > len(words):
        return False
    common = sum(w.lower().strip(",:;'’\"").split("'")[0] in FUNCTION_WORDS for w in words)
    return common >= max(1, len(words) // 8) or not part.isascii()


def features(own: str) -> list[float]:
    """Numbers that describe a mail's own content; all 0 for an empty one."""
    if not own:
        return [0.0] * len(FEATURES)
    lines = [x for x in own.split("\n") if x]
    chars = sum(map(len, lines)) or 1
    bare = LINK.sub(" ", own)
    words = [w.lower() for w in WORD.findall(bare)]
    n = len(words) or 1
    counts = Counter(words)
    links = LINK.findall(own)
    numbers = len(NUMBER.findall(bare))
    sentence = 0
    for line in lines:
        plain, at = LINK.sub(" ", line), 0
        for end in END.finditer(plain):  # only what ends like a sentence can be one
            part, at = plain[at : end.start()], end.end()
            if is_sentence(part):
                sentence += end.end() - end.start() + len(part)
    tags = TAGGED.findall(bare)
    tagged = sum(map(len, tags))
    separators = len(SEPARATOR.findall(bare))
    return [
        float(len(words)),
        sum(map(len, links)) / chars,
        len(links) / len(lines),
        tagged / chars,
        sum(c for w, c in counts.items() if w in FUNCTION_WORDS) / n,
        min(1.0, sentence / chars),
        numbers / (numbers + n),
        len(counts) / n,
        sum(c for _, c in counts.most_common(10)) / n,
        separators / n,
        n / (separators + len(lines)),
        sum(bool(LOG_LINE.search(x)) for x in lines) / len(lines),
        sum(map(str.isupper, own)) / chars,
        float(len(lines)),
        float(len(links)),
        float(len(tags)),
    ]


def weak_label(f: list[float]) -> int:
    """The place in SIGNALS of the signal that speaks clearly, -1 if none does."""
    x = dict(zip(FEATURES, f))
    if x["words"] <= 7 and x["links"] <= 2 and x["lines"] <= 3:
        return SIGNALS.index("note")
    if x["sentence_share"] > 0.8 and x["function_share"] > 0.3:
        return SIGNALS.index("prose")
    if x["sentence_share"] > 0.7 and x["links"] <= 2 and x["type_ratio"] > 0.4:
        return SIGNALS.index("sentences")
    if x["words"] >= 6 and x["function_share"] > 0.35 and x["type_ratio"] > 0.6 and x["links"] <= 2 and x["separators"] < 0.1:
        return SIGNALS.index("talk")
    if x["log_share"] > 0.8:
        return SIGNALS.index("log")
    if x["digit_share"] > 0.8 and x["links"] == 0:
        return SIGNALS.index("numbers")
    if x["link_share"] > 0.6 and x["links"] >= 8:
        return SIGNALS.index("links")
    if x["tag_share"] > 0.6 and x["tags"] >= 8:
        return SIGNALS.index("tags")
    if x["words"] >= 60 and x["type_ratio"] < 0.3 and x["sentence_share"] < 0.15 and x["function_share"] < 0.2 and x["log_share"] == 0.0:
        return SIGNALS.index("repeats")
    if x["words"] >= 40 and x["separators"] > 0.33 and x["chunk_words"] < 3 and x["sentence_share"] < 0.15 and x["digit_share"] < 0.1 and x["type_ratio"] < 0.6:
        return SIGNALS.index("items")
    return -1


def grow(x: np.ndarray, y: np.ndarray, depth: int, least: int, rng: np.random.Generator, tried: int) -> list | float:
    """A decision tree by Gini impurity: [feature, limit, low branch, high branch], or the share of spam in a leaf.

    Each branching tries some of the features, drawn at random: so the trees of a bag come to rest on all of them.
    """
    share = float(y.mean())
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return share
    best = (len(y) * 2 * share * (1 - share) - 1e-9, -1, 0.0)
    for j in rng.permutation(x.shape[1])[:tried].tolist():
        order = np.argsort(x[:, j], kind="stable")
        v, t = x[order, j], y[order]
        low = np.arange(1, len(t))
        ones = np.cumsum(t)[:-1]
        p, q = ones / low, (t.sum() - ones) / (len(t) - low)
        cost = low * 2 * p * (1 - p) + (len(t) - low) * 2 * q * (1 - q)
        cost[(v[1:] == v[:-1]) | (low < least) | (len(t) - low < least)] = np.inf
        if len(cost) and cost.min() < best[0]:
            at = int(cost.argmin())
            best = (float(cost[at]), j, float((v[at] + v[at + 1]) / 2))
    if best[1] < 0:
        return share
    side = x[:, best[1]] <= best[2]
    return [best[1], best[2], grow(x[side], y[side], depth - 1, least, rng, tried), grow(x[~side], y[~side], depth - 1, least, rng, tried)]


def bag(x: np.ndarray, signal: np.ndarray, trees: int = 60, depth: int = 6, least: int = 3, tried: int = 4, seed: int = 11) -> list:
    """Trees, each grown on a bootstrap sample with as many rows of spam as of other mails, spread evenly over their signals."""
    rng = np.random.default_rng(seed)
    own = [(k >= FIRST_SPAM, np.flatnonzero(signal == k)) for k in range(len(SIGNALS))]
    own = [(spam, rows) for spam, rows in own if len(rows)]
    kinds = Counter(spam for spam, _ in own)
    most = max(len(rows) for _, rows in own)
    picks = (np.concatenate([rng.choice(rows, -(-most * max(kinds.values()) // kinds[spam])) for spam, rows in own]) for _ in range(trees))
    return [grow(x[p], (signal[p] >= FIRST_SPAM).astype(float), depth, least, rng, tried) for p in picks]


def predict(model: list, x: np.ndarray) -> np.ndarray:
    """The mean of the trees' shares for each row."""

    def run(tree, rows: np.ndarray, out: np.ndarray) -> None:
        if not isinstance(tree, list):
            out[rows] += tree
        elif len(rows):
            side = x[rows, tree[0]] <= tree[1]
            run(tree[2], rows[side], out)
            run(tree[3], rows[~side], out)

    total = np.zeros(len(x))
    for tree in model:
        run(tree, np.arange(len(x)), total)
    return total / max(1, len(model))


SENDER = re.compile(r"^from:[^\n]*?@([A-Za-z0-9.-]+)", re.I | re.M)
BLANK_LINE = re.compile(r"\n[^\S\n]*\n")


def sender_host(text: str | None) -> str | None:
    """The sender's domain, from the header block: all lines up to the first blank one."""
    text = (text or "").lstrip()
    end = BLANK_LINE.search(text)
    m = SENDER.search(text, 0, end.start() if end else len(text))
    return m[1].lower() if m else None


def page_features(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, host, f, signal) of each mail: host is the sender's domain, f its features, signal its weak label."""
    ship(documents.sparkSession)

    def measure(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = [features(own_content(t)) for t in texts]
            hosts = [sender_host(t) for t in texts]
            values = pa.array(np.asarray(rows, np.float64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, len(FEATURES), dtype=np.int32)), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hosts, pa.string()), lists, pa.array([weak_label(r) for r in rows], pa.int32())], names=["id", "host", "f", "signal"])

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(measure, f"id {rows.schema['id'].dataType.simpleString()}, host string, f array<double>, signal int")


def train(pages: DataFrame, per_signal: int = SAMPLE_PER_SIGNAL) -> list:
    """Bagged trees on a bounded sample of labelled rows: per_signal of each signal, those with the smallest hashes.

    The signals are counted first, so that only about as many rows as are wanted leave the executors. Without rows of
    both sides the model is one leaf.
    """
    counts = {r.signal: r["count"] for r in pages.where("signal >= 0").groupBy("signal").count().collect()}  # a row for each signal
    whole = 1 << 30
    h = F.pmod(F.xxhash64("id"), F.lit(whole))
    shares = {k: whole if n <= per_signal else int(whole * min(1.0, (1.1 * per_signal + 100) / n)) for k, n in counts.items()}
    limit = F.lit(0)
    for k, share in shares.items():
        limit = F.when(F.col("signal") == k, share).otherwise(limit)
    by: dict[int, list] = {}
    for r in pages.where(h < limit).select("signal", h.alias("h"), "f").collect() if shares else []:
        by.setdefault(r.signal, []).append((r.h, r.f))
    held = [(f, k) for k, rows in sorted(by.items()) for _, f in sorted(rows)[:per_signal]]
    signal = np.array([k for _, k in held])
    spam = signal >= FIRST_SPAM
    if not len(held) or spam.all() or not spam.any():
        return [float(spam.mean()) if len(held) else 0.0]
    return bag(np.array([f for f, _ in held]), signal)


def log_odds(p: Column) -> Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def spam_scores(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", weight: float = 0.25, shrink: float = 10.0, per_signal: int = SAMPLE_PER_SIGNAL) -> DataFrame:
    """(id, host, page_score, score): a row for each mail.

    Features of all mails are computed once and settled. Trees are bagged on a bounded sample of mails with a clear signal
    and score every mail: page_score. A host's rate is the mean page score of its other mails, drawn to the archive's mean
    by shrink mails; what its log odds differ from the archive's moves the log odds of the page score by up to weight of
    it. Mails without a readable sender keep their page score. Null, empty and blank texts score as what they are: mails
    without content. Repeated ids get a row each.
    """
    spark = documents.sparkSession
    pages = settle(page_features(documents, id_col=id_col, text_col=text_col))
    model = spark.sparkContext.broadcast(train(pages, per_signal))

    def score(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(len(batch), len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(predict(model.value, x))], names=["id", "host", "page_score"])

    kind = pages.schema["id"].dataType.simpleString()
    scored = settle(pages.mapInArrow(score, f"id {kind}, host string, page_score double"))
    hosts = scored.groupBy("host").agg(F.sum("page_score").alias("total"), F.count(F.lit(1)).alias("n"))
    sums = hosts.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()  # one row
    mean = (sums.total or 0.0) / (sums.n or 1)
    rate = (F.col("total") - F.col("page_score") + F.lit(shrink * mean)) / (F.col("n") - 1 + F.lit(shrink))
    moved = F.coalesce(F.lit(weight) * (log_odds(rate) - log_odds(F.lit(mean))), F.lit(0.0))
    page = F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.col("page_score")))
    smooth = 1 / (1 + F.exp(-(log_odds(page) + moved)))
    return scored.join(hosts.where("host is not null"), "host", "left").select("id", "host", "page_score", smooth.alias("score")).withColumnRenamed("id", id_col)
