"""URL filters: host and path rules, and association rules mined from what they decide; DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
_LABEL = "verdict="

#: The given rules: host and path, verdict.
RULES = {
    "org/": ALLOW,
    "example.org/es/": BLOCK,
    "example.org/en/1": BLOCK,
    "com/fr/": ALLOW,
    "com/de/": BLOCK,
}


def host_of(url: str = "url") -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: str = "url") -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: dict[str, str], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits, null if none does; of equally long ones the first in code-point order.

    A rule fits its host and all subdomains when the path starts with its path.
    """
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        own = (F.col(host) == name) | F.col(host).endswith("." + name)
        fits.append(F.when(own & F.col(path).startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def url_tokens(host: str = "host", path: str = "path", url: str = "url") -> Column:
    """Distinct tokens of a url: scheme, top-level domain, domain, other host labels, every path segment, query keys.

    A segment goes with its place and its whole text, ending included; a number at its start counts by its first digit.
    Of the host, each label is a token of its own: suffixes of it would imply each other, and every token that
    goes with another doubles the combinations.
    """
    labels = F.split(F.col(host), r"\.")
    segments = F.filter(F.split(F.col(path), "/"), lambda s: s != "")
    shape = lambda s: F.regexp_replace(s, r"^([0-9])[0-9]*", r"$1#")
    places = F.transform(segments, lambda s, i: F.concat(F.lit("path"), (i + 1).cast("string"), F.lit("="), shape(s)))
    names = F.array(
        F.concat(F.lit("scheme="), F.translate(F.substring_index(F.col(url), "://", 1), UPPER, LOWER)),
        F.concat(F.lit("tld="), F.element_at(labels, -1)),
        F.when(F.size(labels) > 1, F.concat(F.lit("domain="), F.element_at(labels, -2))),
    )
    others = F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), lambda x: F.concat(F.lit("host="), x))
    keys = F.transform(F.regexp_extract_all(F.col(url), F.lit(r"[?&]([^=&#]+)="), F.lit(1)), lambda k: F.concat(F.lit("key="), k))
    return F.sort_array(F.array_distinct(F.array_compact(F.concat(names, others, places, keys))))


def token_classes(labelled: DataFrame, least: float = 1) -> DataFrame:
    """`token`, `item`, `n` and `everywhere` of the tokens that `least` rows of `row_id`, `tokens` or more have.

    Tokens of the same rows are one item, named by the first of them; rows are the same when their
    count and 128 bits over their ids are. `n` rows have the item; `everywhere` says that all have.
    """
    rows = labelled.select("row_id", F.explode("tokens").alias("token"))
    hashed = F.xxhash64("row_id"), F.xxhash64(F.lit("again"), "row_id")
    seen = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(hashed[0]).alias("a"), F.bit_xor(hashed[1]).alias("b"))
    named = seen.where(F.col("n") >= least).groupBy("n", "a", "b").agg(F.min("token").alias("item"), F.collect_list("token").alias("members"))
    return named.select(F.explode("members").alias("token"), "item", "n", (F.col("n") == labelled.count()).alias("everywhere"))


def with_items(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """`set_id` and `items` (`item`, `n`), those that rows tell apart, for each row of `set_id`, `tokens` that has any."""
    own = sets.select("set_id", F.explode("tokens").alias("token")).join(classes.where("not everywhere"), "token")
    return own.groupBy("set_id").agg(F.sort_array(F.collect_set(F.struct("item", "n"))).alias("items"))


def mine_rules(labelled: DataFrame, classes: DataFrame, least: float, min_confidence: float) -> DataFrame:
    """Association rules `items` -> `label` from rows of `row_id`, `tokens` and `label`, with `confidence` and `support`.

    FP-growth finds the combinations that `least` rows or more have; a rule is kept when at least `min_confidence` of the rows with its
    items have its label. Items stand for tokens as in `token_classes`: combinations of tokens of one class, or with
    tokens that all rows have, would only repeat a rule. A rule without items stands for the latter alone. The rules'
    number is bounded by the support, not by the data.
    """
    n = max(1, labelled.count())
    found = with_items(labelled.select(F.col("row_id").alias("set_id"), "tokens"), classes)
    names = F.coalesce(F.col("items.item"), F.array().cast("array<string>"))
    marked = F.concat(names, F.array(F.concat(F.lit(_LABEL), "label"))).alias("items")
    items = stored(labelled.join(found, labelled["row_id"] == found["set_id"], "left").select(marked), "url-items")
    support = min(1.0, (math.ceil(least) - 0.5) / n)
    frequent = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items).freqItemsets
    is_label = lambda t: t.startswith(_LABEL)
    # only rules that lead to a verdict: a combination with a label next to the same without
    sets = stored(
        frequent.select(
            F.sort_array(F.filter("items", lambda t: ~is_label(t))).alias("items"),
            F.get(F.filter("items", is_label), F.lit(0)).substr(len(_LABEL) + 1, 1000).alias("label"), "freq",
        ),
        "item-sets",
    )
    alone = sets.where("label is null").select("items", F.col("freq").alias("of"))
    all_rows = F.when(F.size("items") == 0, F.lit(n))
    return (
        sets.where("label is not null").join(alone, "items", "left").withColumn("of", F.coalesce(all_rows, "of"))
        .select("items", "label", (F.col("freq") / F.col("of")).alias("confidence"), (F.col("freq") / F.lit(n)).alias("support"))
        .where(F.col("confidence") >= min_confidence)
    )


def match_rules(sets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """`set_id` and `label` of the best rule of each row of `set_id`, `tokens`; rows that no rule matches are left out.

    An inverted index leads from an item to the rules whose rarest one it is; such a
    rule matches when its other items are found too, and one without items where a token that all labelled rows have is. The best has the
    highest confidence, then support, then the most items, then comes first by items and label.
    """
    best = F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (-F.size("rule")).alias("m"), F.col("rule"), F.col("label")
    ).alias("best")
    known = rules.withColumnRenamed("items", "rule")
    counts = classes.select(F.col("item").alias("part"), "n").distinct()
    parts = known.where("size(rule) > 0").select("*", F.explode("rule").alias("part")).join(counts, "part")
    index = parts.groupBy("rule", "label", "confidence", "support").agg(F.min(F.struct("n", "part"))["part"].alias("item"))
    asked = with_items(sets, classes).select("set_id", F.col("items.item").alias("items"))
    tried = asked.select("*", F.explode("items").alias("item")).join(index, "item").where(F.size(F.array_except("rule", "items")) == 0)
    matched = tried.select("set_id", best)
    # at most one row per label
    plain = known.where("size(rule) = 0").orderBy(F.desc("confidence"), F.desc("support"), "label").first()
    if plain is not None:
        usual = sets.select("set_id", F.explode("tokens").alias("token")).join(classes.where("everywhere").select("token"), "token", "left_semi")
        empty = F.array().cast("array<string>").alias("rule")
        alike = [F.lit(plain[c]).alias(c) for c in ("label", "confidence", "support")]
        matched = matched.unionByName(usual.select("set_id").distinct().select("set_id", empty, *alike).select("set_id", best))
    return matched.groupBy("set_id").agg(F.min("best").alias("best")).select("set_id", F.col("best.label").alias("label"))


def judge_urls(
    df: DataFrame, rules: dict[str, str] | None = None, min_support: float = 0.005, min_confidence: float = 0.8, min_rows: int = 5
) -> DataFrame:
    """`page_id`, `host`, `path`, `rule` and `verdict` per row of `df` (`page_id`, `url`); other columns are not read.

    Urls that a rule decides are the labels from which rules over token combinations are mined, those that `min_support` of the
    labelled rows have, and `min_rows` of them; the rules judge the other urls, one judgement for each distinct set of tokens. A url whose
    path is empty fits no rule with a path, not even `/`. Without a matching combination, without any labels,
    and for null urls and urls without `://` the verdict is allow. Repeated rows are judged each; an empty
    table gives no rows.
    """
    rules = RULES if rules is None else rules
    urls = df.select("page_id", "url", host_of().alias("host"), path_of().alias("path"))
    label = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()], F.lit(None).cast("string"))
    pages = stored(
        urls.withColumn("rule", rule_of(rules)).withColumn("label", label)
        .withColumn("tokens", F.when(F.col("host") != "", url_tokens()).otherwise(F.array().cast("array<string>")))
        .withColumn("set_id", F.col("tokens")).withColumn("row_id", F.monotonically_increasing_id()).drop("url"),
        "urls",
    )
    labelled = pages.where("label is not null").select("row_id", "tokens", "label")
    least = max(min_support * labelled.count(), min_rows)
    classes = stored(token_classes(labelled, least), "token-classes")
    mined = stored(mine_rules(labelled, classes, least, min_confidence), "url-rules")
    sets = pages.where("label is null").select("set_id", "tokens").distinct()
    judged = stored(match_rules(sets, mined, classes).select("set_id", F.col("label").alias("mined")), "judged")
    verdict = F.coalesce("label", F.when(F.col("label").isNull(), F.col("mined")), F.lit(ALLOW))
    return pages.join(judged, "set_id", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
