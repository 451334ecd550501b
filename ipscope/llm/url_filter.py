"""URL filter: explicit rules first, then logistic regression on hashed character n-grams.

All of it is DataFrame expressions.  A URL is cut into host and path; every run of
``sizes`` characters of either, the ends marked, is hashed to one of ``buckets``
features.  The regression is fitted by accelerated gradient descent: each round is
one Spark aggregation over the labelled table, and only the gradient (at most
``buckets`` numbers) comes back.  Scoring reads each URL on its own, without a
shuffle, so a host that holds most pages costs nothing extra.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ipscope.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules (host, path, verdict) of the registered query.  A rule is named host + path.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: The labelled table: invented URLs of kinds that crawls leave out, and of kinds they keep.
BLOCKED = (
    "http://www.best-online-casino.test/bonus/free-spins", "https://casino-royal-slots.test/play?id=3", "http://win-big-casino.test/",
    "https://poker-and-bets.test/register", "http://sports-bets-today.test/odds/football", "https://free-betting-tips.test/win",
    "https://lotto-jackpot-win.test/claim", "http://roulette-bonus.test/signup.html", "https://m.slots-free-money.test/spin/12",
    "http://cheap-meds-online.test/buy-viagra", "https://discount-pills-store.test/cialis/order", "http://pharmacy-pills.test/no-prescription",
    "https://buy-cheap-pills.test/en/offer", "http://www.weight-loss-pills.test/order.html", "https://cheap-replica-watches.test/sale",
    "http://cheap-handbags-outlet.test/discount", "https://adult-videos.test/watch/99", "http://xxx-cams.test/live",
    "https://free-porn-tube.test/video/1234", "http://hot-adult-dating.test/join", "https://adult-content-x.test/gallery/7",
    "http://escort-girls.test/city/4", "https://sex-chat-x.test/rooms", "http://spam-links.test/page/1",
    "https://link-farm-seo.test/backlinks", "http://www.content-farm.test/article/spun", "https://spam-blog-network.test/post/88",
    "http://buy-backlinks-farm.test/order", "https://article-spam.test/keyword/loan", "https://ads-server.test/click?cid=9",
    "http://track-ads.test/pixel.gif", "https://ad-tracker.test/redirect/55", "http://popunder-ads.test/serve", "https://ads.clicktrack.test/imp",
    "http://payday-loan-fast.test/apply", "https://bad-credit-loans.test/apply-now", "http://get-rich-quick.test/invest",
    "https://crypto-doubler-win.test/deposit", "http://free-iphone-win.test/claim-prize", "https://account-verify-login.test/secure/update",
    "http://keygen-crack-download.test/setup.exe", "https://warez-free-download.test/full", "http://torrent-movies-free.test/download",
    "https://malware-host.test/update.exe", "http://phish-bank-login.test/verify", "https://hacked-accounts.test/dump")
ALLOWED = (
    "https://www.university.test/department/physics", "http://library.college.test/catalog/books", "https://docs.python-lib.test/en/3/tutorial",
    "http://news.daily-herald.test/2023/world", "https://www.newspaper.test/politics/article-123", "http://museum.test/collection/paintings",
    "https://en.encyclopedia.test/wiki/History", "http://de.encyclopedia.test/wiki/Geschichte", "https://blog.gardener.test/en/roses",
    "http://recipes.kitchen.test/bread/rye", "https://www.city-council.test/services/transport", "http://weather.test/forecast/today",
    "https://health.ministry.test/guidelines", "http://hospital.test/visitors", "https://research.institute.test/papers/2021/04",
    "http://forum.photography.test/thread/18", "https://blog.traveller.test/fr/voyage", "http://shop.bookstore.test/novels/classic",
    "https://school.test/timetable.html", "http://www.theatre.test/programme", "https://music.orchestra.test/concerts/spring",
    "http://history.society.test/letters/1848", "https://code.repository.test/project/readme", "http://www.nature-park.test/trails/north",
    "https://theater.nation.test/de/spielplan", "http://athletics.test/results/2022", "https://m.thinktank.test/en/report/671",
    "http://blog.mathteacher.test/es/algebra", "https://chess-club.test/games/1", "http://www.another-story.test/chapter/9",
    "https://weathering.test/en/148.html", "http://method.test/guide?page=2", "https://northern-lights.test/en/photos#top",
    "http://truth-and-method.test/essay", "https://birthplace.test/es/797", "http://www.thirteen.test/fr/825?ref=x",
    "https://m.station.test/en/25#top", "http://nation.test/de/612?utm_source=feed", "https://www.therapy.test/advice/384",
    "http://blog.brother.test/en/960", "https://feathers.test/birds/65.html", "http://rhythm.test/lessons/328/",
    "https://mother-tongue.test/de/533/", "http://threads.test/knitting/414", "https://m.thesis.test/en/334/", "http://worth-reading.test/list/453")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased (a
    port or user name stays in it); the path then goes up to ``?``, ``#`` or the end.  Both
    are empty for a null URL and one without ``://``.
    """
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, shape, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null.

    A rule fits its host and all subdomains where the path starts with the rule's.  Of
    rules of one length the greatest name wins, then the verdict block.  Rules are tried
    one by one on each row, so there should be hundreds at most.
    """
    table = F.from_json(F.lit(json.dumps([{"host": h, "path": p, "verdict": v} for h, p, v in rules])),
                        "array<struct<host:string,path:string,verdict:string>>")
    fits = F.filter(table, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    name = lambda r: F.concat(r["host"], r["path"])
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(name(r)).alias("length"), name(r).alias("name"), (r["verdict"] == "block").alias("block"), r["verdict"].alias("verdict"))))
    return F.when(best.isNotNull(), F.struct(best["name"].alias("name"), best["verdict"].alias("verdict")))


def features(host: Column, path: Column, buckets: int, sizes: tuple[int, ...]) -> Column:
    """Buckets of the character n-grams of host and path, repeats counted; an empty part has none.

    A part is split into code points once, so its cost grows with its length.
    """
    def grams(mark: str, part: Column, size: int) -> Column:
        chars = F.split(F.concat(F.lit("^"), part, F.lit("$")), "")
        hashes = lambda c: F.transform(
            F.sequence(F.lit(1), F.size(c) - (size - 1)),
            lambda i: F.pmod(F.xxhash64(F.concat(F.lit(mark), F.array_join(F.slice(c, i, size), ""))), F.lit(buckets)).cast("int"))
        # Bound once by a one-element transform; otherwise every n-gram would split the part again.
        found = F.element_at(F.transform(F.array(chars), lambda c: F.when(F.size(c) >= size, hashes(c))), 1)
        return F.when(part != "", F.coalesce(found, F.array().cast("array<int>"))).otherwise(F.array().cast("array<int>"))

    return F.concat(*[grams(m, p, n) for m, p in (("h", host), ("p", path)) for n in sizes])


@dataclass(frozen=True)
class Model:
    """Weights of the buckets and the constant; features as ``features`` makes them."""

    weights: tuple[float, ...]
    bias: float
    sizes: tuple[int, ...]

    def probability(self, found: Column) -> Column:
        return 1 / (1 + F.exp(-score(found, self.weights, self.bias)))


def score(found: Column, weights, bias: float) -> Column:
    """Constant plus the sum of the features' weights over the root of their number."""
    table = F.from_json(F.lit(json.dumps(list(weights))), "array<double>")  # folded to one literal
    total = F.aggregate(found, F.lit(0.0), lambda z, b: z + F.get(table, b))
    return F.lit(float(bias)) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url, blocked."""
    rows = [{"url": u, "blocked": y} for us, y in ((BLOCKED, True), (ALLOWED, False)) for u in us]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), "array<struct<url:string,blocked:boolean>>")))


def fit(labelled: DataFrame, url: str = "url", blocked: str = "blocked", buckets: int = 1 << 13,
        sizes: tuple[int, ...] = (2, 3, 4), rounds: int = 40, rate: float = 6.0, ridge: float = 1e-3) -> Model:
    """Logistic regression by Nesterov's accelerated gradient descent from zero.

    ``labelled`` is a small table; a round is one aggregation over it, which sends at most
    ``buckets`` sums.  Rows without a label or URL are left out.  Without any row the
    model says 0.5 for everything, with rows of one label only it leans to that label.
    Weights are rounded to nine decimals, so the order of summing does not show.
    """
    host, path = parts(F.col("url"))
    rows = staged(labelled.select(F.col(url).alias("url"), F.col(blocked).cast("boolean").cast("double").alias("y"))
                  .filter("url IS NOT NULL AND y IS NOT NULL")
                  .select("y", features(host, path, buckets, sizes).alias("f")), "url_labels")
    count = rows.count()
    weights, bias = [0.0] * buckets, 0.0
    last, last_bias = weights, bias
    for k in range(rounds if count else 0):
        ahead = k / (k + 3)
        look = [w + ahead * (w - v) for w, v in zip(weights, last)]
        look_bias = bias + ahead * (bias - last_bias)
        error = 1 / (1 + F.exp(-score(F.col("f"), look, look_bias))) - F.col("y")
        share = error / F.sqrt(F.greatest(F.size("f"), F.lit(1)).cast("double"))
        # The constant is the bucket -1 of every row, with the plain error as its share.
        sums = (rows.select(F.explode(F.concat(F.transform("f", lambda b: F.struct(b.alias("b"), share.alias("e"))),
                                               F.array(F.struct(F.lit(-1).alias("b"), error.alias("e"))))).alias("x"))
                .groupBy("x.b").agg(F.sum("x.e").alias("e")).collect())
        last, last_bias, weights = weights, bias, [w - rate * ridge * w for w in look]
        for b, e in sums:
            if b < 0:
                bias = round(look_bias - rate * e / count, 9)
            else:
                weights[b] -= rate * e / count
        weights = [round(w, 9) for w in weights]
    return Model(tuple(weights), bias, sizes)


def judge(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", rules=RULES, threshold: float = 0.5) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, block_probability.

    rule is the name of the longest rule that fits (null where none does) and verdict its
    verdict; without a rule the verdict is block where the model's probability is at least
    ``threshold``, else allow.  block_probability is the model's whatever the rules say.
    A null URL, and one without ``://``, has an empty host and path and gets the model's
    constant.  Long URLs are read whole.  Repeated rows are judged alike; a null
    page_id stays null.  An empty table gives no rows.  Other columns are not read.
    """
    host, path = parts(F.col("url"))
    cut = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    found = features(F.col("host"), F.col("path"), len(model.weights), model.sizes)
    # The features are bound once, for the sum and for their number.
    probability = F.element_at(F.transform(F.array(found), model.probability), 1)
    scored = cut.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("fits"), probability.alias("block_probability"))
    return scored.select("page_id", "host", "path", F.col("fits.name").alias("rule"),
                         F.coalesce("fits.verdict", F.when(F.col("block_probability") >= threshold, "block").otherwise("allow")).alias("verdict"),
                         "block_probability")
