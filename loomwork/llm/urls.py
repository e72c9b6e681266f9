"""URL filters: domain rules, and a logistic regression on hashed character n-grams for urls that no rule fits.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path runs
from there up to ``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host and path. A rule is a
host and a path written together: it fits its host and all subdomains where the url's path starts with the rule's;
the longest rule wins, and of two equally long ones the first by its text. Rules are compiled into one expression; the model
is trained in numpy from a small labelled table and sent to the tasks, one number for each bucket. Empty urls are judged
like others, by their marks alone. Repeated rows are judged alike; very long urls and further columns don't matter.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm._common import bounded_batches

#: (verdict, rule) of the registered query.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

#: Labelled urls: 1 is to be blocked.
LABELLED = (
    ("http://cheap-pills.test/buy/viagra?aff=9", 1),
    ("http://www.cheap-pills.shop/order/now", 1),
    ("https://buy-cheap-meds.test/pills/discount", 1),
    ("https://pharmacy-discount.shop/cheap/pills", 1),
    ("http://adult-x.test/videos/xxx/1", 1),
    ("https://m.adult-x.tv/cams/live", 1),
    ("https://xxx-cams.test/adult/free", 1),
    ("http://hot-adult-video.test/sex/42", 1),
    ("https://ads-track.test/click?id=1", 1),
    ("https://www.ads-track.click/pixel/2", 1),
    ("http://ad-server.test/banner/track", 1),
    ("https://click-tracker.test/redirect/ads", 1),
    ("http://casino-win.test/slots/bonus", 1),
    ("https://poker-casino.bet/free/spins", 1),
    ("https://bet-casino-online.test/jackpot", 1),
    ("http://free-download-crack.test/keygen/serial", 1),
    ("https://warez-crack.test/download/full", 1),
    ("http://win-prize-now.test/claim/gift", 1),
    ("https://loan-fast-cash.test/apply/now", 1),
    ("https://replica-watches.shop/cheap/luxury", 1),
    ("http://spam-links.test/seo/backlinks", 1),
    ("https://get-rich-quick.test/money/fast", 1),
    ("http://fake-login.test/bank/verify", 1),
    ("https://malware-host.test/update/exe", 1),
    ("https://www.city-library.test/en/catalogue/12", 0),
    ("https://news.daily-post.test/world/2021/05/story", 0),
    ("https://blog.garden-notes.test/en/roses", 0),
    ("https://university.test/physics/lecture/3", 0),
    ("http://museum.test/fr/exposition/7", 0),
    ("https://docs.software.test/guide/install", 0),
    ("https://wiki.history.test/de/seite/9", 0),
    ("https://recipes.kitchen.test/soup/lentil", 0),
    ("http://weather.test/en/forecast/today", 0),
    ("https://www.school.test/es/curso/22", 0),
    ("https://research.institute.test/papers/88", 0),
    ("https://forum.cycling.test/en/topic/5", 0),
    ("http://blog.travel.test/fr/voyage/31", 0),
    ("https://open-data.gov.test/en/table/14", 0),
    ("https://hospital.test/en/clinic/hours", 0),
    ("https://theatre.test/de/spielplan/2", 0),
    ("https://m.news-weekly.test/en/sport/61", 0),
    ("https://books.test/en/novel/review/4", 0),
    ("http://www.music-school.test/es/clase/8", 0),
    ("https://science.magazine.test/en/article/17", 0),
    ("https://blog.programming.test/en/page/825?page=2", 0),
    ("https://council.test/en/minutes/2020", 0),
    ("http://www.farm-market.test/fr/produit/3", 0),
    ("https://photo.club.test/de/galerie/19", 0),
)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
GRAMS = (3, 4, 5)
#: An odd number that grams are multiplied by; a product's upper bits are the bucket.
MIX = 0x9E3779B97F4A7C15
#: Rows that a labelled table may have: it is collected and learned from in the driver.
MAX_LABELLED = 10_000


def host(url: Column) -> Column:
    """Empty for null."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    rule = verdict = None
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct buckets of each url's n-grams, for a whole batch at once. The grams of a host and
    of a path, with a mark at both ends, are told apart."""
    rows, buckets = [], []
    for part, texts in ((1, hosts), (2, paths)):
        marked = [b"^" + t.encode() + b"$" for t in texts]
        lengths = np.array([len(t) for t in marked], np.int64)
        data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        row = np.repeat(np.arange(len(marked)), lengths)
        for n in GRAMS:
            starts = max(len(data) - n + 1, 0)
            whole = row[:starts] == row[n - 1 :]  # within one text
            gram = np.full(starts, n * 4 + part, np.uint64)
            for i in range(n):
                gram = gram << np.uint64(8) | data[i : i + starts]
            mixed = (gram[whole] * np.uint64(MIX)) >> np.uint64(64 - BUCKET_BITS)
            rows.append(row[:starts][whole])
            buckets.append(mixed.astype(np.int64))
    each = np.unique(np.concatenate(rows) << BUCKET_BITS | np.concatenate(buckets))
    return each >> BUCKET_BITS, each & (BUCKETS - 1)


@dataclasses.dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    intercept: float

    def score(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        row, bucket = features(hosts, paths)
        z = np.bincount(row, self.weights[bucket], len(hosts)) / np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1))
        return 1 / (1 + np.exp(-(self.intercept + z)))


def train(labelled: Sequence[tuple[str, str, int]], epochs: int = 300, rate: float = 0.5, decay: float = 1e-3) -> UrlModel:
    """Fit (host, path, label) rows by gradient descent."""
    if not labelled:
        return UrlModel(np.zeros(BUCKETS), 0.0)
    hosts, paths, labels = zip(*labelled, strict=True)
    row, bucket = features(hosts, paths)
    share = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1))
    y = np.array(labels, float)
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(epochs):
        z = np.bincount(row, w[bucket], len(y)) * share + b
        gap = 1 / (1 + np.exp(-z)) - y
        step = np.bincount(bucket, (gap * share)[row], BUCKETS)
        w -= rate * (step / len(y) * 10 + decay * w)
        b -= rate * gap.mean()
    return UrlModel(w, b)


def train_table(labelled: DataFrame) -> UrlModel:
    """From a DataFrame (url, label) of at most MAX_LABELLED rows with a label; more raise."""
    parts = labelled.where("label is not null").select(host(F.col("url")), path(F.col("url")), F.col("label").cast("int"))
    rows = parts.limit(MAX_LABELLED + 1).collect()
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    return train(sorted(tuple(r) for r in rows))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score): ``score`` is the model's, for every url, 1 likelier to be blocked."""
    if labelled is None:
        labelled = pages.sparkSession.createDataFrame(list(LABELLED), "url string, label int")
    model = pages.sparkSession.sparkContext.broadcast(train_table(labelled))
    bounded_batches(pages.sparkSession)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = model.value
        for hosts, paths in parts:
            yield pd.Series(m.score(hosts.tolist(), paths.tolist()), dtype="float64")

    url = F.col(f"`{url_col}`")
    split = pages.select(F.col(f"`{id_col}`").alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    scored = split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), score("host", "path").alias("score"))
    by_model = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")
