"""URL filter: host and path rules, and a logistic regression for the rest.

A url's host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or
the end, with A-Z lowered; its path goes on up to ``?``, ``#`` or the end.  A
rule fits its host and all subdomains, if the path starts with the rule's; the
longest rule that fits decides.  Rules are looked up by the suffixes of the
host, so their number does not matter.

A url that no rule fits is judged by a logistic regression on hashed character
n-grams of host and path (digits alike, ends marked), trained in numpy from a
small labelled table of urls, ``LABELLED_URLS`` unless another is given.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; host and path together empty have nothing to judge and are
allowed (score 0); of rules of equal length the one with the longer host
decides; an empty path fits only a rule with an empty path; very long urls are
read whole; equal urls have equal verdicts and each row gives one; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import map_batches

ALLOW, BLOCK = "allow", "block"
#: Verdict, host and path of each rule.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)

#: The labelled table: urls that a crawl should leave out (1) or keep (0).
LABELLED_URLS = tuple(
    [(u, 1) for u in (
        "http://casino-win.example.org/en/12.html", "https://www.casino-royal.example.net/de/81",
        "https://m.online-casino.example.info/play/", "http://blog.casino-bonus.example.org/fr/3",
        "http://free-bets.example.org/en/5462", "https://www.sports-bets.example.net/en/77/",
        "https://m.bets-today.example.biz/odds", "http://best-bets.example.info/es/4.html",
        "http://poker-win.example.org/en/9", "https://jackpot-slots.example.net/spin/881",
        "https://cheap-pills.example.org/de/6652.html", "http://www.pills-online.example.net/en/3/",
        "http://m.cheap-meds.example.biz/order", "https://blog.diet-pills.example.org/en/77",
        "http://buy-viagra.example.net/en/1", "https://rx-pharmacy.example.info/cheap/",
        "https://ads-track.example.org/en/9823", "http://m.ads-server.example.net/click/5",
        "http://www.ad-track.example.biz/pixel", "https://click-track.example.org/fr/2301/",
        "https://popup-ads.example.net/en/4", "http://banner-ads.example.info/show/19",
        "http://spam-farm.example.org/fr/907", "https://www.link-farm.example.net/en/8601/",
        "https://m.seo-spam.example.biz/en/212", "http://blog.spam-links.example.org/de/5.html",
        "http://content-farm.example.info/es/41", "https://adult-x.example.org/en/27126",
        "http://www.adult-video.example.net/de/3", "https://m.xxx-adult.example.biz/view/7",
        "http://adult-chat.example.org/en/15.html", "http://sex-cams.example.net/live/2",
        "https://payday-loans.example.org/apply", "http://fast-cash-win.example.net/en/6",
        "https://crack-keygen.example.info/download/3", "http://free-warez.example.biz/en/11/",
        "https://win-prize.example.org/claim/1", "http://replica-watches.example.net/buy/70",
    )]
    + [(u, 0) for u in (
        "http://www.library.example.org/en/1291/", "https://museum.example.net/en/77.html",
        "https://blog.gardening.example.org/de/5931", "http://m.weather.example.net/en/20",
        "http://university.example.org/fr/408", "https://www.recipes.example.net/en/17/",
        "https://city.example.org/es/66.html", "http://blog.travel.example.net/de/9/",
        "http://history.example.org/en/1800", "https://m.science.example.net/en/42",
        "https://www.school.example.org/fr/6094", "http://health.example.net/en/7",
        "http://m.news.example.org/en/8423", "https://www.sport.example.net/de/12.html",
        "https://blog.music.example.org/es/3", "http://cinema.example.net/en/985/",
        "http://www.parliament.example.org/en/52", "https://maps.example.net/en/6",
        "https://dictionary.example.org/de/71/", "http://m.astronomy.example.net/en/14",
        "http://forest.example.org/fr/4163", "https://www.bakery.example.net/en/30.html",
        "https://blog.hiking.example.org/en/2518/", "http://railway.example.net/de/88",
        "http://www.theatre.example.org/en/482/", "https://ocean.example.net/en/19",
        "https://m.mathematics.example.org/en/873", "http://blog.painting.example.net/de/7",
        "http://therin.example.org/en/21", "https://www.thonti.example.net/en/5",
        "https://blog.ererha.example.org/de/640/", "http://m.tionand.example.net/en/33.html",
        "http://hathon.example.org/es/10", "https://nothing.example.net/en/4439",
        "https://www.inthere.example.org/fr/1152", "http://lyther.example.net/de/2/",
        "http://blog.ouring.example.org/en/7376", "https://m.stonbe.example.net/en/91",
        "http://gardens.example.org/en/6", "https://www.castles.example.net/de/31/",
        "http://m.rivers.example.org/en/204", "https://birds.example.net/fr/8.html",
        "http://blog.letters.example.org/es/77", "https://www.trains.example.net/en/5120",
        "http://old-town.example.org/en/18", "https://open-data.example.net/en/9/",
    )]
)

SIZES = (3, 4, 5)
BUCKETS = 1 << 14
ROUNDS, RATE, DECAY = 400, 2.0, 1e-3
#: The intercept is not learned: a url whose n-grams say nothing is likely fine,
#: however many of the small table's are not.
INTERCEPT = -2.0
THRESHOLD = 0.5
#: Host and path pairs that a worker remembers the score of.
REMEMBERED = 50_000
_DIGITS = str.maketrans("123456789", "0" * 9)


def grams(host: str, path: str) -> np.ndarray:
    """Buckets of the n-grams that host and path hold, each once."""
    found = set()
    for mark, part in (("h", host), ("p", path)):
        text = f"^{part}$".translate(_DIGITS)
        found.update(mark + text[i : i + n] for n in SIZES for i in range(len(text) - n + 1))
    return np.unique([crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in found]).astype(np.int64)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a url, as :func:`judge_urls` takes them."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    stop = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    lower = {c: c + 32 for c in range(65, 91)}
    return rest[:end].translate(lower), rest[end:stop] if stop >= end else ""


class Judge:
    """The trained regression: weights of the buckets and the intercept."""

    def __init__(self, weights: np.ndarray, intercept: float) -> None:
        self.weights, self.intercept = weights, intercept
        self.known: dict[tuple[str, str], float] = {}

    def score(self, host: str, path: str) -> float:
        """How likely the url is one to leave out; 0 if there is nothing to judge."""
        if not host and not path:
            return 0.0
        key = (host, path.translate(_DIGITS))
        score = self.known.get(key)
        if score is None:
            at = grams(host, path)
            score = float(1 / (1 + np.exp(-(self.intercept + self.weights[at].sum() / np.sqrt(len(at) or 1)))))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(host) + len(path) < 1000:
                self.known[key] = score
        return score


def fit(labelled: Sequence[tuple[str, int]] = LABELLED_URLS) -> Judge:
    """Logistic regression by gradient descent on a small labelled table (url, 0 or 1)."""
    rows = [grams(*split_url(url)) for url, _ in labelled]
    wanted = np.array([label for _, label in labelled], float)
    features = np.zeros((len(rows), BUCKETS))
    for k, at in enumerate(rows):
        features[k, at] = 1 / np.sqrt(len(at) or 1)
    weights = np.zeros(BUCKETS)
    for _ in range(ROUNDS if len(rows) else 0):
        wrong = 1 / (1 + np.exp(-(features @ weights + INTERCEPT))) - wanted
        weights -= RATE * (features.T @ wrong / len(rows) * 10 + DECAY * weights)
    return Judge(weights, INTERCEPT)


class RuleBook:
    """Rules by their host."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]) -> None:
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host, []).append((path, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule and verdict of the longest rule that fits."""
        best, size = None, (-1, -1)
        while host:
            for start, verdict in self.by_host.get(host, ()):
                if path.startswith(start) and (len(host) + len(start), len(host)) > size:
                    best, size = (host + start, verdict), (len(host) + len(start), len(host))
            _, dot, host = host.partition(".")
            if not dot:
                break
        return best


def with_parts(pages: DataFrame) -> DataFrame:
    """``page_id`` with the host and path of its url."""
    rest = "case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = pages.select("page_id", F.expr(f"coalesce({rest}, '')").alias("rest"))
    return parts.select(
        "page_id",
        F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), upper, lower).alias("host"),
        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, judge: Judge | None = None
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every page; ``score``
    is null where a rule decides."""
    judge = judge or fit()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        book = RuleBook(rules)
        found, verdicts, scores = [], [], []
        for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
            rule = book.find(host, path)
            score = None if rule else judge.score(host, path)
            found.append(rule[0] if rule else None)
            verdicts.append(rule[1] if rule else BLOCK if score >= THRESHOLD else ALLOW)
            scores.append(score)
        return pa.record_batch(
            {
                "page_id": batch.column("page_id"),
                "host": batch.column("host"),
                "path": batch.column("path"),
                "rule": pa.array(found, pa.string()),
                "verdict": pa.array(verdicts, pa.string()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    parts = with_parts(pages.selectExpr("cast(page_id as long) as page_id", "cast(url as string) as url"))
    return map_batches(parts, work, "page_id long, host string, path string, rule string, verdict string, score double")
