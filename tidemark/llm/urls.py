"""URL filtering by association rules, with DataFrame functions and Spark's FP-growth only."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable

# Host, path and verdict of the given rules: fixed values.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct sorted tokens: labels of the host (h:), words of the path (p:), digits as one sign."""
    def split(c: Column, mark: str) -> Column:
        plain = F.regexp_replace(c, r"[0-9]+", "0")
        words = F.filter(F.split(plain, r"[^\p{L}\p{N}]+"), lambda w: w != "")
        return F.transform(words, lambda w: F.concat(F.lit(mark), w))

    return F.array_sort(F.array_distinct(F.concat(split(host, "h:"), split(path, "p:"))))


def telling_tokens(host: Column, path: Column, given) -> Column:
    """``tokens_of`` less what only restates the given rules: the top-level domain, a language segment of two
    letters at the start of the path, and the words of the given hosts and paths."""
    bare = F.regexp_replace(host, r"\.?[^.]*\z", "")
    rest = F.regexp_replace(path, r"\A/[A-Za-z]{2}(?=/|\z)", "")
    restated = [tokens_of(F.lit(h), F.lit(p)) for h, p, _ in given]
    tokens = tokens_of(bare, rest)
    return F.array_except(tokens, F.flatten(F.array(*restated))) if restated else tokens


def item_classes(folded: DataFrame, fewest: int) -> DataFrame:
    """``token, item, n_all, n_block`` of every token that ``fewest`` labelled rows have.

    Tokens that stand in exactly the same rows are one item, named after the smallest of them: any
    rule with one of them is as sure as with another or with several. Rows are compared by two 64-bit hashes.
    """
    each = folded.select("n_all", "n_block", F.xxhash64("tokens").alias("h"), F.xxhash64(F.lit(1), "tokens").alias("g"), F.explode("tokens").alias("token"))
    rows = ["n_all", "n_block", "sets", "h", "g"]
    tokens = durable(each.groupBy("token").agg(
        F.sum("n_all").alias("n_all"), F.sum("n_block").alias("n_block"), F.count("*").alias("sets"), F.bit_xor("h").alias("h"),
        F.bit_xor("g").alias("g")).where(F.col("n_all") >= fewest))
    return durable(tokens.join(tokens.groupBy(*rows).agg(F.min("token").alias("item")), rows).select("token", "item", "n_all", "n_block"))


def combinations(rows: DataFrame, folded: DataFrame, items: DataFrame, verdict: str, fewest: int) -> DataFrame | None:
    """``items, n_all, n_hit`` of all sets of two and more of ``items`` (``token``) that ``fewest`` rows of the verdict have, by FP-growth.

    Only rows with two of the items can hold such a set, so the others do not enter.
    """
    each = folded.select("tokens", F.explode("tokens").alias("token")).join(items, "token", "left_semi")
    lists = durable(each.groupBy("tokens").agg(F.array_sort(F.collect_list("token")).alias("items")).where("size(items) > 1"))  # of one url
    if lists.isEmpty():
        return None
    mark = F.lit("=")  # no token starts so
    taken = rows.join(lists, "tokens").select(
        F.when(F.col("verdict") == verdict, F.array_append("items", mark)).otherwise(F.col("items")).alias("items"))
    taken = durable(taken)
    # The fit rounds support times rows up.
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, (fewest - 0.5) / taken.count())).fit(taken).freqItemsets
    found = durable(found.select(F.array_sort(F.array_remove("items", "=")).alias("items"), F.array_contains("items", "=").alias("hit"), "freq"))
    sets = found.where("size(items) > 1")
    return sets.where("hit").select("items", F.col("freq").alias("n_hit")).join(
        sets.where("not hit").select("items", F.col("freq").alias("n_all")), "items")


def minimal(rules: DataFrame) -> DataFrame:
    """The ``rules`` that hold no smaller one, by growing size, each size against those kept before by one of their items."""
    rules = durable(rules.withColumn("n", F.size("items")).withColumn("rule_id", F.xxhash64("items", "blocks")))
    kept = rules.where("false")
    for (n,) in sorted(rules.select("n").distinct().collect()):
        these = rules.where(F.col("n") == n)
        inner = kept.select(F.col("items")[0].alias("item"), F.col("items").alias("inner"))
        held = (these.select("rule_id", "items", F.explode("items").alias("item")).join(inner, "item")
                .where(F.size(F.array_except("inner", "items")) == 0).select("rule_id").distinct())
        kept = durable(kept.unionAll(these.join(held, "rule_id", "left_anti").select(*kept.columns)))
    return kept.select("rule_id", "items", "n", "blocks", "confidence")


def mine_rules(rows: DataFrame, support: float = 0.002, confidence: float = 0.8, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """Rules ``rule_id, items, n, blocks, confidence`` mined from ``tokens`` and ``verdict``, and the items' ``token, item``.

    Support and confidence are shares of the rows with a verdict. A rule stands on ``least`` of them at least, so
    that a token is not condemned for one or two rows, and must be surer than its verdict is over all of them, so
    that a token that most rows have implies nothing. A rule that holds a shorter one of its verdict is none, so each is minimal. Any
    token of an item stands for it. Single items come first; those that imply a verdict are in no other of its rules, and
    FP-growth runs over the rest only, once for each verdict. Equal rows are folded for all but that. Its work is
    exponential in the number of items that ``least`` rows share of which none implies the verdict and no two always go together.
    """
    rows = rows.where("verdict is not null").select("tokens", "verdict")
    folded = durable(rows.groupBy("tokens").agg(F.count("*").alias("n_all"), F.count_if(F.col("verdict") == "block").alias("n_block")))
    total, blocks = folded.agg(F.coalesce(F.sum("n_all"), F.lit(0)), F.coalesce(F.sum("n_block"), F.lit(0))).first()
    fewest = max(least, math.ceil(support * total - 1e-9))
    classes = item_classes(folded, fewest)
    found = None
    for verdict, n in (("block", blocks), ("allow", total - blocks)):
        if n in (0, total):
            continue  # nothing can be surer than its share
        sure = F.col("n_hit") / F.col("n_all")
        passes = (sure >= confidence) & (sure / F.lit(n / total) > 1 + 1e-9)
        hits = F.col("n_block") if verdict == "block" else F.col("n_all") - F.col("n_block")
        single = classes.where("token = item").withColumn("n_hit", hits).where(F.col("n_hit") >= fewest)
        rules = single.where(passes).select(F.array("item").alias("items"), sure.alias("confidence"))
        several = combinations(rows, folded, single.where(~passes).select("token"), verdict, fewest)
        if several is not None:
            rules = rules.unionAll(several.where(passes).select("items", sure.alias("confidence")))
        rules = minimal(rules.withColumn("blocks", F.lit(verdict == "block")))
        found = rules if found is None else found.unionAll(rules)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "rule_id long, items array<string>, n int, blocks boolean, confidence double")
    return found, classes.select("token", "item")


def judge(pages: DataFrame, given=RULES, support: float = 0.002, confidence: float = 0.8) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, confidence``.

    The longest given rule that fits decides; rows so decided carry the labels that
    the token rules are mined from. For the rest, each distinct token set is looked
    up in an inverted index of the mined rules; the surest rule wins, ties block.
    Words that only restate the given rules are no tokens, see ``telling_tokens``.
    Without any rule, without labels, and for null urls the verdict is allow. Repeated rows are
    judged alike and come back once each; very long urls are taken whole. Columns of ``pages``
    with the five names are replaced, any others stay as they are.
    """
    rest = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "confidence")]
    base = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for host, path, says in sorted(given, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    base = base.withColumns({"rule": rule, "verdict": verdict, "tokens": telling_tokens(F.col("host"), F.col("path"), given)})
    decided, open_ = base.where("rule is not null"), base.where("rule is null")
    rules, classes = mine_rules(decided, support, confidence)
    index = rules.select("rule_id", "blocks", F.col("confidence").alias("sure"), "n", F.explode("items").alias("item"))
    sets = open_.where("size(tokens) > 0").select("tokens").distinct()
    has = sets.select("tokens", F.explode("tokens").alias("token")).join(classes, "token").select("tokens", "item").distinct()
    fired = durable(has.join(index, "item").groupBy("tokens", "rule_id", "blocks", "sure", "n").agg(F.count("*").alias("met")).where("met = n")
                    .groupBy("tokens").agg(F.max(F.struct("sure", "blocks")).alias("best")))
    # Rows of equal urls may be many: the few rules fired are written, so that they are sent or the rows are split.
    learned = F.when(F.col("best.blocks"), "block").otherwise("allow")
    judged = open_.join(fired, "tokens", "left").select("row.*", "host", "path", "rule", learned.alias("verdict"), F.col("best.sure").alias("confidence"))
    return decided.select("row.*", "host", "path", "rule", "verdict", F.lit(None).cast("double").alias("confidence")).unionAll(judged)


def op3_urls(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "confidence")
