"""URL filters: allow and block rules first, boosted trees on lexical features for what no rule covers.

A rule names a host and the beginning of a path; it fits that host and its subdomains, and the longest rule that fits
decides. The other URLs are judged by gradient-boosted trees trained on labelled URLs. Features are lexical (lengths,
depth, shares of digits and signs, entropy, parameters) and statistics of host suffixes counted over all URLs given (URLs
and hosts under the host, its last two labels and its last one). All of it is SQL functions and Spark ML in the JVM.

One bound, a parameter: the trees learn from at most ``train_urls`` distinct labelled URLs, those of lowest hash. Rules
may be many: up to ``INLINE_RULES`` are literals of the plan, more are joined on host suffix and path beginning.

Cases: a null URL counts as empty (no host, no path, no rule); repeated rows each get their verdict; with labels of one kind
only the verdict is that kind's, without any it is ``allow``; an empty table gives an empty result. Columns of the input are
kept, those named like added ones are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarspark.session import reliable_checkpoint

TRAIN_URLS = 10_000
INLINE_RULES = 200
ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def under(host: Column, top: Column) -> Column:
    """Whether a host is ``top`` or one of its subdomains."""
    return (host == top) | F.endswith(host, F.concat(F.lit("."), top))


def _inline(rows: DataFrame, rules: list) -> DataFrame:
    """The longest fitting rule from literals; ties go to the longer host."""
    fits = [F.when(under(F.col("host"), F.lit(r["host"])) & F.startswith(F.col("path"), F.lit(r["path"])),
                   F.struct(F.lit(len(r["host"] + r["path"])).alias("size"), F.lit(len(r["host"])).alias("of_host"),
                            F.lit(r["host"] + r["path"]).alias("rule"), F.lit(r["verdict"]).alias("verdict"))) for r in rules]
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,of_host:int,rule:string,verdict:string>")
    return rows.withColumn("best", best)


def _joined(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by joins: distinct (host, path) meet the path lengths known for each suffix of the host, then the rule
    itself by equality, so candidates grow with labels and lengths and not with the rules of a host."""
    at = F.sequence(F.lit(1), F.size(F.split("host", r"\.")))
    pages = rows.select("host", "path").distinct()
    suffixes = pages.select("host", "path", F.explode(at).alias("k")).select(
        "host", "path", F.expr("array_join(slice(split(host, '[.]'), -k, k), '.')").alias("top"))
    lengths = rules.select(F.col("host").alias("top"), F.length("path").alias("n")).distinct()
    heads = suffixes.join(lengths, "top").where(F.length("path") >= F.col("n")).select(
        "host", "path", "top", F.expr("substr(path, 1, n)").alias("head"))
    named = rules.select(F.col("host").alias("top"), F.col("path").alias("head"), "verdict")
    size = F.struct((F.length("top") + F.length("head")).alias("size"), F.length("top").alias("of_host"),
                    F.concat("top", "head").alias("rule"), "verdict")
    best = heads.join(named, ["top", "head"]).groupBy("host", "path").agg(F.max(size).alias("best"))
    return rows.join(reliable_checkpoint(best, "url-rules"), ["host", "path"], "left")


def match_rules(df: DataFrame, rules: DataFrame, url_col: str = "url", inline: int = INLINE_RULES) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``rule_verdict`` (both null if none fits). ``rules`` has host, path
    and verdict (allow or block); of rules with the same host and path a blocking one counts."""
    added = ("host", "path", "rule", "rule_verdict")
    own = [c for c in df.columns if c not in added]
    rows = df.select(F.struct(*own).alias("row"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    few = rules.limit(inline + 1).collect()
    found = _inline(rows, few) if len(few) <= inline else _joined(rows, rules)
    return found.select("row.*", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def _taken(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _entropy(text: Column) -> Column:
    """Bits a character, from the counts of the distinct characters."""
    letters = F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def one(acc: Column, c: Column) -> Column:
        p = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
        return acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0)

    return F.aggregate(letters, F.lit(0.0), one)


def lexical_features() -> dict[str, Column]:
    """Features from the columns ``text`` (the URL), ``host`` and ``path``."""
    text, host, path = F.col("text"), F.col("host"), F.col("path")
    n = F.greatest(F.length(text), F.lit(1))
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    return {
        "url_length": F.length(text), "host_length": F.length(host), "path_length": F.length(path),
        "depth": _taken(path, "/"), "host_labels": _taken(host, ".") + 1, "host_signs": _taken(host, "-_:@"),
        "digit_ratio": _taken(text, "0123456789") / n, "host_digits": _taken(host, "0123456789"),
        "sign_ratio": _taken(text, "-_.~!*'();:@&=+$,/?#[]%") / n, "entropy": _entropy(text), "host_entropy": _entropy(host),
        "params": F.when(query == "", 0).otherwise(_taken(query, "&") + 1), "query_length": F.length(query),
        "fragment": F.contains(text, F.lit("#")).cast("int"), "encrypted": F.startswith(F.lower(text), F.lit("https:")).cast("int"),
        "extension": F.length(F.regexp_extract(path, r"\.([^./]*)$", 1)),
    }


SUFFIX = ["host_urls", "two_urls", "two_hosts", "last_urls", "last_hosts"]


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """(host, host_urls, two_urls, two_hosts, last_urls, last_hosts): logarithms of how many URLs have the host, and of the URLs
    and hosts under its last two labels and its last one. Counted over all rows, by host first, so a common host is one
    number a task when suffixes are summed."""
    hosts = reliable_checkpoint(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "url-hosts")
    out = hosts.select("host", F.log1p("n").alias("host_urls"))
    for name, labels in (("two", 2), ("last", 1)):
        suffix = F.substring_index("host", ".", -labels)
        sums = reliable_checkpoint(hosts.groupBy(suffix.alias("suffix")).agg(
            F.log1p(F.sum("n")).alias(f"{name}_urls"), F.log1p(F.count(F.lit(1))).alias(f"{name}_hosts")), "url-suffixes")
        out = out.withColumn("suffix", F.substring_index("host", ".", -labels)).join(sums, "suffix").drop("suffix")
    return reliable_checkpoint(out, "url-suffixes")


def _vectors(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """``rows`` (text, host, path and others) with ``features``."""
    lexical = lexical_features()
    names = [*lexical, *SUFFIX]
    known = rows.join(statistics.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left").drop("of")
    numbers = known.withColumns({k: v.cast("double") for k, v in lexical.items()} | {k: F.coalesce(k, F.lit(0.0)) for k in SUFFIX})
    return VectorAssembler(inputCols=names, outputCol="features").transform(numbers).drop(*names)


def train_url_model(labelled: DataFrame, statistics: DataFrame, url_col: str = "url", label_col: str = "label",
                    train_urls: int = TRAIN_URLS, trees: int = 20, depth: int = 4):
    """Boosted trees from labelled URLs (label 1: block, 0: allow, null: not labelled), or the one label seen (none: 0).
    A URL labelled both ways counts as blocked. The sample is one partition, so training gives the same trees each time."""
    urls = (labelled.where(F.col(label_col).isNotNull()).groupBy(F.coalesce(F.col(url_col), F.lit("")).alias("text"))
                    .agg(F.max(label_col).cast("double").alias("label")))
    sample = reliable_checkpoint(urls.orderBy(F.xxhash64("text"), "text").limit(train_urls), "url-train")
    kinds = sample.agg(F.min("label").alias("least"), F.max("label").alias("most")).first()
    if kinds["most"] is None or kinds["least"] == kinds["most"]:
        return float(kinds["most"] or 0.0)
    rows = sample.withColumns({"host": url_host(F.col("text")), "path": url_path(F.col("text"))})
    ready = reliable_checkpoint(_vectors(rows, statistics).coalesce(1).sortWithinPartitions(F.xxhash64("text"), "text"), "url-features")
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7).fit(ready.select("features", "label"))


def score_urls(df: DataFrame, model, statistics: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` with ``score``, the probability that a URL is to be blocked."""
    own = [c for c in df.columns if c != "score"]
    url = F.coalesce(F.col(url_col), F.lit(""))
    if isinstance(model, float):
        return df.select(*own, F.lit(model).alias("score"))
    rows = df.select(F.struct(*own).alias("row"), url.alias("text"), url_host(url).alias("host"), url_path(url).alias("path"))
    scored = model.transform(_vectors(rows, statistics))
    return scored.select("row.*", vector_to_array("probability")[1].alias("score"))


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", labels: DataFrame | None = None,
               train_urls: int = TRAIN_URLS, block_at: float = 0.5) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    ``labels`` has the URL and ``label``; without it the URLs that rules decide are the labelled ones. The verdict is the
    rule's, or else block at a score of ``block_at`` or more.
    """
    matched = match_rules(df.drop("verdict", "score"), rules, url_col)
    statistics = suffix_statistics(matched.select("host"))
    if labels is None:
        labels = matched.where("rule IS NOT NULL").select(url_col, (F.col("rule_verdict") == BLOCK).cast("int").alias("label"))
    scored = score_urls(matched, train_url_model(labels, statistics, url_col, train_urls=train_urls), statistics, url_col)
    own = F.when(F.col("score") >= block_at, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.withColumn("verdict", F.coalesce("rule_verdict", own)).drop("rule_verdict")
