"""URL filter: longest-match rules, else logistic regression on n-grams.

Features of a URL are its character n-grams of 3 to 5, those of the host and of
the path apart, hashed to a fixed number of dimensions. The model is fitted on
the driver from a small labelled URL table (a parameter; ``seed_table`` makes
the default one from word lists), and its weight vector has a fixed size.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased. Path: from there up to ``?``, ``#`` or the end.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is judged by the model as such; ids repeat or are null freely;
of several fitting rules the longest text wins, at equal length a block; other
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtide.session import ship_code

DIMENSIONS = 1 << 18

#: The rules of the query: action, then host suffix with path prefix.
RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")

BAD = "spam farm casino win adult xxx porn pills cheap viagra bets bet gambling poker slots ads track tracker popunder payday loan replica crack warez torrent escort jackpot lottery phish malware nude webcam".split()
GOOD = "news blog library school museum garden weather health recipes travel docs wiki research city history music science help support forum daily journal press sport art photo film books maps code data open project team club church town river".split()
#: Syllables for hosts that say nothing of their pages.
PLAIN = "an ble ed en er es ha he in ing ly nd on or re sh st th the ti tion wh mar lo ka sen".split()
#: Words and shapes of the second part, taken from no table: common nouns, and
#: words of blocked pages, in URLs of other domains and paths. No clean word holds
#: a blocked one.
MORE_BAD = "lotto betting bookie roulettes gamble highroller freespins pokies sexcam hotgirls milf hardcore fetish stripper xvideo hookups sexchat lingerie kamagra phentermine xanax diet-pills steroid weightloss getrichquick fastcash quickcash nocreditcheck forex-robot binary-options cryptodouble airdrop giveaway clickhere popup adclick adserve banner-ads trackers pixel-track malware-host virus-download keygens serials cracked nulled iptv-free free-movies fake-id counterfeit essay-writers buy-followers link-exchange seo-backlinks spamlist bulkmail phisher scam ponzi".split()
MORE_GOOD = "airport animal architect atlas autumn balcony basket beach bicycle biology bridge butter camera canal candle carpenter castle chapel cheese chess citizen climate coffee college copper council country culture dance desert dinner doctor economy engine evening factory family fashion festival fishing flower forest furniture future gallery geography glacier government grammar guitar harbor heritage hiking holiday horse hotel housing insurance island jewelry journey kitchen lake language lawyer lecture leather lighthouse literature local magazine market mathematics medicine mineral minister mountain nature network nursery ocean office opera painting parents physics piano planet poetry police pottery-class prairie printing public radio rainbow reading recipe region repair restaurant road sailor school-board season seminar shelter singer society software soldier spring station stone student summer surgery swimming teacher temple tennis timber tourism tractor traffic train translation tree university-press valley vegetable village violin volunteer water wood writer zebra".split()
SHAPES = ("https://www.{}.com/", "http://{}.net/index.html", "https://{}online.org/articles/12-title", "http://best{}.us/view.asp?x=1", "https://{}.dev/read/me", "https://{}.de/kategorie/seite", "http://{}.fr/accueil", "https://shop.{}.com/cart/items/9", "https://{}.ac.jp/staff/list", "http://{}-group.eu/contact", "https://en.{}.info/wiki/Main_Page", "http://news.{}.ca/2019/05/item.php")


def seed_table() -> list[tuple[str, int]]:
    """The default labelled URLs, (url, 1 to block), made by rule."""


    def shaped(stem: str, turn: int) -> str:
        """The stem in one of the shapes that both classes share evenly."""
        prefix, tail = ("", "www.", "m.", "blog.")[turn % 4], ("", ".html", "/", "?page=2")[turn // 2 % 4]
        return f"http{'s' * (turn % 2)}://{prefix}{stem}.example.{('com', 'net', 'org')[turn % 3]}/{('en', 'de', 'fr', 'es')[turn // 3 % 4]}/{37 * turn % 900}{tail}"

    rows, turn = [], 0
    for i, word in enumerate(BAD):
        other = BAD[(7 * i + 3) % len(BAD)]
        for stem in (f"{word}-{other}", word, f"{word}-x", f"{other}{word}"):
            rows.append((shaped(stem, turn), 1))
            turn += 1
    turn = 0
    for i, word in enumerate(GOOD):
        for k in range(4):
            plain = PLAIN[(5 * i + k) % len(PLAIN)] + PLAIN[(3 * i + 7 * k) % len(PLAIN)] + PLAIN[(i + k) % len(PLAIN)] * (i % 2)
            rows += [(shaped(word if k else f"{word}-{plain}", turn), 0), (shaped(plain, turn + 1), 0)]
            turn += 1
    # Both classes go through the shapes in the same turn.
    for words, label in ((BAD + MORE_BAD, 1), (GOOD + MORE_GOOD, 0)):
        rows += [(SHAPES[(5 * i + 7 * k) % len(SHAPES)].format(word), label) for i, word in enumerate(words) for k in range(3 + 2 * label)]
    return rows


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a URL, both empty where there is no ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    stop = min((at for at in map(rest.find, "?#") if at >= 0), default=len(rest))
    # A-Z only: other letters keep their case.
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, rest[end:stop] if stop > end else ""


class Rules:
    """Rules by their host, for the suffixes of a URL's host."""

    def __init__(self, lines: tuple[str, ...]):
        self.by_host: dict[str, list[tuple[int, bool, str, str, str]]] = {}
        for line in lines:
            action, rule = line.split(" ", 1)
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((len(rule), action == "block", slash + path, rule, action))
        for found in self.by_host.values():
            found.sort(reverse=True)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The winning rule and its action."""
        best = None
        parts = host.split(".")
        for i in range(len(parts)):
            for rule in self.by_host.get(".".join(parts[i:]), ()):
                if path.startswith(rule[2]):
                    best = max(best, rule) if best else rule
                    break
        return (best[3], best[4]) if best else None


def features(part: str, space: str) -> list[int]:
    """Dimensions of the n-grams of a host or path."""
    text = f"^{part}$"
    return [zlib.crc32(f"{space}{text[i : i + n]}".encode()) % DIMENSIONS for n in (3, 4, 5) for i in range(len(text) - n + 1)]


class UrlModel:
    """Weights of hashed n-grams; hosts' sums are remembered."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.hosts: dict[str, tuple[float, int]] = {}

    def score(self, host: str, path: str) -> float:
        """Probability that the URL is to be blocked."""
        if host not in self.hosts:
            if len(self.hosts) > 100_000:
                self.hosts = {}
            at = features(host, "h")
            self.hosts[host] = float(self.weights[at].sum()), len(at)
        (a, n), at = self.hosts[host], features(path, "p")
        z = self.bias + (a + float(self.weights[at].sum())) / math.sqrt(max(1, n + len(at)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(labelled: list[tuple[str, int]], rounds: int = 400, rate: float = 2.0, ridge: float = 1e-4) -> UrlModel:
    """Logistic regression by full-batch gradient descent, the same every time."""
    rows, dims, scale = [], [], []
    for r, (url, _) in enumerate(labelled):
        host, path = split_url(url)
        at = features(host, "h") + features(path, "p")
        rows += [r] * len(at)
        dims += at
        scale += [1 / math.sqrt(max(1, len(at)))] * len(at)
    rows, scale, y = np.array(rows), np.array(scale), np.array([label for _, label in labelled], float)
    used, dims = np.unique(dims, return_inverse=True)
    weights, bias = np.zeros(len(used)), 0.0
    for _ in range(rounds):
        z = np.bincount(rows, scale * weights[dims], len(y)) + bias
        error = 1 / (1 + np.exp(-z)) - y
        weights -= rate * (np.bincount(dims, scale * error[rows], len(used)) / len(y) * 10 + ridge * weights)
        bias -= rate * error.mean()
    full = np.zeros(DIMENSIONS, np.float32)
    full[used] = weights
    return UrlModel(full, float(bias))


def judged(pages: DataFrame, rules: tuple[str, ...] = RULES, model: UrlModel | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Id, host, path, rule, score and verdict of each row, in one map."""
    spark = pages.sparkSession
    ship_code(spark)
    model = model or fit(seed_table())
    shared = spark.sparkContext.broadcast((model.weights, model.bias))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, listed = UrlModel(*shared.value), Rules(rules)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                found = listed.match(host, path)
                score = judge.score(host, path)
                out.append((host, path, found[0] if found else None, score, found[1] if found else "block" if score >= 0.5 else "allow"))
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.string(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "host", "path", "rule", "score", "verdict"])

    return pages.select(pages[id_col].alias(id_col), F.col(url_col).alias("_url")).mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, score double, verdict string")


def op7(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))
