"""URL filter: host words by Viterbi, then multinomial naive Bayes, behind rules.

Host labels are split into words by the most probable
segmentation under a unigram model (counts of the words that URLs write with
separators, plus the given word lists; an unknown word costs more the longer
it is).  The tokens of a URL are its segmented host words and its path words.
Multinomial naive Bayes learns block from the URLs whose host has a word of
``block_words`` and allow from the others, and judges every URL; smoothed
counts of all tokens of all URLs enter, a token as often as its URL has it.
Unigrams, splits of host words and token counts are tables; what needs them is
joined to them, the most frequent keys with a salt, and only totals and the
hashes of those keys (``HOT``) reach the driver.

Rules come first: a rule is (host, path, verdict); it fits its host and all
subdomains when the URL's path starts with the rule's path, and the longest
rule (host and path) wins.

Defined cases: a null URL or one without ``://`` has an empty host and path,
no rule, and is judged by the prior; rows that repeat an id each get a row; an
empty table gives no rows; other columns are not read.  Words and paths may have
any length: the pieces of a word are looked up by their first 24 letters, in
parts of 256 letters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import ascii_lower, map_arrow, through_table

#: Words that name hosts to block; the seeds of the classifier.
BLOCK_WORDS = ("adult", "ads", "bet", "bets", "bonus", "casino", "cheap", "cialis", "clickbait", "dating", "escort", "farm",
               "free", "gambling", "hookup", "jackpot", "loan", "loans", "payday", "pills", "poker", "porn", "replica",
               "sex", "slots", "spam", "track", "tracker", "tracking", "viagra", "warez", "win", "xxx")
#: Words of ordinary hosts, which no block word may swallow.
PLAIN_WORDS = ("blog", "com", "example", "mail", "m", "net", "news", "org", "shop", "the", "to", "web", "wiki", "www")
_SPLIT = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")
#: Letters by which a piece is looked up, and places of a word that are looked up by one row.
_HEAD, _PART = 24, 256
#: Keys that are spread over the salts: as many of the most frequent ones.
HOT = 1024


def url_parts(url: str):
    """(host, path) columns: host after the first `://` up to `/ ? #`, A-Z lower-cased; path up to `? #`."""
    u = F.col(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def segment(word: str, cost: dict[str, float], unknown: float) -> list[str]:
    """The cheapest split of ``word``: Viterbi over unigram costs; an unknown piece costs ``unknown`` and 2 a letter.

    No known piece may cost more than it would as an unknown one."""
    if word in cost or len(word) < 2:
        return [word]
    sizes = sorted({len(w) for w in cost}, reverse=True)
    best, back = [0.0] + [math.inf] * len(word), [0] * (len(word) + 1)
    start, low = 0, 0.0  # the best place for an unknown piece to start, and its cost without the letters up to it
    for end in range(1, len(word) + 1):
        best[end], back[end] = low + unknown + 2.0 * end, start
        for size in sizes:
            if size <= end:
                c = cost.get(word[end - size:end])
                if c is not None and best[end - size] + c < best[end]:
                    best[end], back[end] = best[end - size] + c, end - size
        if best[end] - 2.0 * end < low:
            start, low = end, best[end] - 2.0 * end
    out, end = [], len(word)
    while end:
        out.append(word[back[end]:end])
        end = back[end]
    return out[::-1]


def _path_words(path: str) -> list[str]:
    return _SPLIT.findall(path.lower())


class UrlFilter:
    """fit() counts unigrams and tokens of all URLs into tables; judge() adds the verdicts."""

    def __init__(self, rules: list[tuple[str, str, str]], block_words=BLOCK_WORDS, plain_words=PLAIN_WORDS,
                 seed_count: int = 1000, salts: int = 16):
        self.rules, self.block_words, self.plain_words = rules, frozenset(block_words), frozenset(plain_words)
        self.seed_count, self.salts = seed_count, salts

    @staticmethod
    def parts(df: DataFrame, url_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
        host, path = url_parts(url_col)
        return df.select(*keep, host.alias("host"), path.alias("path"))

    def _look_up(self, rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
        """Left join on ``key``; rows of the most frequent keys are spread by ``by``, and only their entries copied."""
        most = rows.groupBy(F.xxhash64(key).alias("h")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "h").limit(HOT)
        hot = F.xxhash64(key).isin([r.h for r in most.collect()])
        copies = F.sequence(F.lit(0).cast("long"), F.lit(self.salts - 1).cast("long"))
        rows = rows.withColumn("salt", F.when(hot, F.pmod(F.xxhash64(by), F.lit(self.salts))).otherwise(F.lit(0).cast("long")))
        table = table.withColumn("salt", F.explode(F.when(hot, copies).otherwise(F.array(F.lit(0).cast("long")))))
        return rows.join(table, [key, "salt"], "left").drop("salt")

    def _cuts(self, hosts: DataFrame) -> DataFrame:
        """(word, cut) of the host words that are split."""
        words = hosts.select(F.explode(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0))).alias("word"))
        words = through_table(words.where(F.length("word") > 1).distinct().withColumn("key", F.xxhash64("word")), "words")
        # words of one key, if there should ever be two, share what is known: a piece that a word has not is never asked for
        parts = words.select("key", F.explode(F.transform(
            F.sequence(F.lit(1), F.length("word"), F.lit(_PART)),
            lambda at: F.struct(F.col("word").substr(at, F.lit(_PART + _HEAD - 1)).alias("text"),
                                F.least(F.lit(_PART), F.length("word") - at + 1).alias("places")))).alias("part"))
        text = F.col("part.text")
        heads = F.flatten(F.transform(F.sequence(F.lit(1), F.col("part.places")), lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(_HEAD), F.length(text) - i + 1)), lambda k: text.substr(i, k))))
        heads = parts.select("key", F.explode(F.array_distinct(heads)).alias("head"))
        entries = self.unigrams.withColumn("head", F.col("token").substr(1, _HEAD))
        known = self._look_up(heads, entries, "head", "key").where(F.col("token").isNotNull())
        known = known.groupBy("key").agg(F.collect_set(F.struct("token", "n")).alias("known"))
        known = words.join(known, "key", "left").select("word", F.coalesce("known", F.array().cast(known.schema["known"].dataType)))
        total = self.total

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = b.column(0).to_pylist()
                costs = [{x["token"]: math.log(total / x["n"]) for x in k} for k in b.column(1).to_pylist()]
                cuts = [segment(w, c, math.log(total) + 2.0) for w, c in zip(own, costs)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cuts, pa.list_(pa.string()))], names=["word", "cut"])

        return map_arrow(known, cut, "word string, cut array<string>").where(F.size("cut") > 1)

    def _with_words(self, hosts: DataFrame) -> DataFrame:
        """(host, host_words) of distinct hosts."""
        parts = F.regexp_extract_all("host", F.lit(r"[a-z]+|[0-9]+|[^\x00-\x7f]+"), F.lit(0))
        words = hosts.select("host", F.posexplode_outer(parts).alias("pos", "word"))
        words = self._look_up(words, through_table(self._cuts(hosts), "cuts"), "word", "host")
        one = F.when(F.col("word").isNotNull(), F.struct("pos", F.coalesce("cut", F.array("word")).alias("cut")))
        return words.groupBy("host").agg(F.flatten(F.sort_array(F.collect_list(one)).getField("cut")).alias("host_words"))

    @staticmethod
    def _tokens(urls: DataFrame) -> DataFrame:
        """(url, token, times) of rows (url, path, host_words), and how often; "" counts the URLs."""
        def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [Counter([*words, *("/" + w for w in _path_words(path)), ""])
                         for path, words in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                found = pa.array([list(c.items()) for c in found], pa.map_(pa.string(), pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), found], names=["url", "tokens"])

        schema = T.StructType([urls.schema["url"], T.StructField("tokens", T.MapType(T.StringType(), T.LongType()))])
        rows = map_arrow(urls.select("url", "path", "host_words"), tokens, schema)
        return rows.select("url", F.explode("tokens").alias("token", "times"))

    def _urls(self, df: DataFrame, url_col: str) -> DataFrame:
        """One row per host and path: url (both), path, host_words, n."""
        urls = self.parts(df, url_col).groupBy("host", "path").agg(F.count("*").alias("n"))
        urls = through_table(urls, "urls")
        words = through_table(self._with_words(urls.select("host").distinct()), "host-words")
        salted = self._look_up(urls, words, "host", "path")
        return through_table(salted.select(F.struct("host", "path").alias("url"), "path", "host_words", "n"), "url-words")

    def fit(self, df: DataFrame, url_col: str) -> "UrlFilter":
        # URLs of one host count by host, so that a host with a third of the URLs is one row from here on
        hosts = self.parts(df, url_col).groupBy("host").agg(F.count("*").alias("n"))

        # words that labels and paths set apart by other characters; a label of one long run is what is to be split
        labels = hosts.select(F.explode(F.split("host", r"[.]")).alias("label"), "n").where(F.col("label").rlike("[^a-z]"))
        apart = labels.select(F.explode(F.split("label", r"[^a-z]+")).alias("token"), "n")
        paths = self.parts(df, url_col).groupBy("path").agg(F.count("*").alias("n"))
        paths = paths.select(F.explode(F.split(F.lower("path"), r"[^a-z]+")).alias("token"), "n")
        seen = apart.union(paths).where(F.length("token") > 0).groupBy("token").agg(F.sum("n").alias("n"))
        seeds = df.sparkSession.createDataFrame(
            [(w, self.seed_count) for w in sorted(self.block_words | self.plain_words)], "token string, seed long")
        seen = seen.join(F.broadcast(seeds), "token", "left").select("token", F.greatest("n", F.coalesce("seed", "n")).alias("n"))
        missing = F.broadcast(seeds).join(seen, "token", "left_anti").select("token", F.col("seed").alias("n"))
        self.unigrams = through_table(seen.union(missing), "unigrams")
        self.total = (self.unigrams.agg(F.sum("n")).first()[0] or 0) + 1

        urls = self._urls(df, url_col)
        self._fitted = df, url_col, urls
        bad = F.arrays_overlap("host_words", F.array(*map(F.lit, sorted(self.block_words))))
        sides = urls.select(F.struct(F.col("url.host"), F.col("url.path"), "n", bad.alias("bad")).alias("url"), "path", "host_words")
        tokens = self._tokens(sides).select("token", (F.col("url.n") * F.col("times")).alias("n"), "url.bad")
        self.model = through_table(tokens.groupBy("token").agg(
            F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("block"),
            F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("allow")), "tokens")
        all_, own = self.model.where("token = ''").first(), self.model.where("token != ''")
        allow, block = (all_.allow, all_.block) if all_ else (0, 0)
        x = own.agg(F.count("*").alias("size"), F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
        self.sums = [(v or 0) + x["size"] + 1 for v in (x.allow, x.block)]
        self.prior = math.log((block + 1) / (allow + 1))
        return self

    def judge(self, df: DataFrame, url_col: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
        """``keep``, host, path, rule (host/path of the rule, else null), verdict, log_odds (above 0: block), host_words."""
        rows = self.parts(df, url_col, keep)
        urls = self._fitted[2] if self._fitted[0] is df and self._fitted[1] == url_col else self._urls(df, url_col)
        odds = self.model.where("token != ''").select("token", (
            F.log((F.col("block") + 1) / F.lit(float(self.sums[1]))) - F.log((F.col("allow") + 1) / F.lit(float(self.sums[0])))).alias("odds"))
        scores = self._look_up(self._tokens(urls), odds, "token", "url").groupBy("url").agg(
            F.sort_array(F.collect_list(F.when(F.col("odds").isNotNull(), F.struct("token", (F.col("odds") * F.col("times")).alias("odds"))))).alias("found"))
        score = F.aggregate("found", F.lit(0.0), lambda acc, x: acc + x["odds"]) + F.lit(self.prior)  # in one order: always the same sum
        scores = urls.join(scores, "url").select("url.host", "url.path", "host_words", score.alias("log_odds"))
        rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
        for host, path, says in sorted(self.rules, key=lambda r: len(r[0]) + len(r[1])):  # the longest is tried first
            host = host.lower()
            fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
            rule = F.when(fits, F.lit(host + path)).otherwise(rule)
            verdict = F.when(fits, F.lit(says)).otherwise(verdict)
        spread = rows.withColumn("url", F.struct("host", "path")).withColumn("spread", F.monotonically_increasing_id())
        scores = scores.select(F.struct("host", "path").alias("url"), "host_words", "log_odds")
        out = self._look_up(spread, through_table(scores, "scores"), "url", "spread")
        return out.select(*keep, "host", "path", rule.alias("rule"),
                          F.coalesce(verdict, F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"),
                          "log_odds", "host_words")
