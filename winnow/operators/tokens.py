"""Frequent first words of texts, and the patterns made of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Words that say what was done, and words that say nothing.
ACTIONS = (
    "add", "added", "fix", "fixed", "merge", "remove", "removed", "update", "updated", "use", "using", "allow", "make", "move", "rename", "convert",
    "drop", "dont", "do", "introduce", "expand", "fold", "kill", "annotate", "optimize", "provide", "teach", "change", "set", "take", "unify",
    "replace", "clean", "cleanup", "build", "disable", "enable", "accept", "prevent", "return", "split", "simplify", "reset", "restore", "print",
    "mark", "validate", "export", "extract", "construct", "create", "delete", "lift", "pass", "raise", "force", "automate", "abort",
)
COMMON = (
    "the", "and", "for", "with", "from", "into", "next", "branch", "tag", "of", "git", "https", "http", "linux", "kernel", "driver", "drivers",
    "tools", "selftests", "samples", "documentation", "maintainers", "patch", "patches",
)
#: Prefixes that go first, and those of them that are listed whether they occur or not.
PREFERRED = (
    "net", "can", "ethernet", "phy", "phylib", "phylink", "mdio", "ethtool", "ipv4", "ipv6", "tcp", "udp", "tls", "xfrm", "vlan", "bluetooth", "wifi",
    "wireless", "cfg80211", "mac80211", "nl80211", "usb", "pci", "tty", "serial", "i2c", "spi", "pinctrl", "gpio", "irqchip", "clk", "regulator",
    "thermal", "watchdog", "pm", "cpufreq", "cpuidle", "mmc", "ufs", "mtd", "block", "ext4", "f2fs", "ubifs", "nvdimm", "dm", "scsi", "nvme", "iommu",
    "crypto", "security", "keys", "integrity", "selinux", "apparmor", "kasan", "ubsan", "fortify", "arm", "arm64", "dt", "dt-bindings", "devicetree",
    "of",
)
ALWAYS = (
    "net", "can", "usb", "pci", "arm64", "crypto", "security", "mmc", "ext4", "thermal", "watchdog", "pm", "bluetooth", "wireless", "dt-bindings",
    "of",
)
#: A word of letters, digits and _+.- that stands on its own, before a space or a colon; a version.
TOKEN = r"(?<![A-Za-z0-9_./-])([A-Za-z][A-Za-z0-9_+.-]{1,40})(?=\s|:)"
VERSION = r"^v?\d+(?:[.-]\d+)*$"


#: Tokens that a sketch keeps at first and at most, and candidates for each of those asked for.
TRACKED, MOST_TRACKED, CANDIDATES = 16_384, 1_000_000, 4


def tokens_of(texts: DataFrame, column: str = "text", stop: tuple[str, ...] = (*ACTIONS, *COMMON)) -> DataFrame:
    """token: lower-cased tokens, without stops and commas at their ends, of two letters at least, that are no stop word or version."""
    found = texts.select(F.explode(F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(TOKEN), F.lit(1))).alias("t"))
    token = F.lower(F.regexp_replace("t", r"^[.,]+|[.,]+$", ""))
    return found.select(token.alias("token")).where((F.length("token") >= 2) & ~F.col("token").isin(*stop) & ~F.col("token").rlike(VERSION))


def token_counts(texts: DataFrame, column: str = "text", stop: tuple[str, ...] = (*ACTIONS, *COMMON)) -> DataFrame:
    """token, n of all tokens; see tokens_of."""
    return tokens_of(texts, column, stop).groupBy("token").agg(F.count("*").alias("n"))


def most_frequent(tokens: DataFrame, pool: int = 200, tracked: int = TRACKED) -> DataFrame:
    """token, n: exactly the `pool` most frequent of tokens(token), ties by token, without a shuffled row for every distinct one.

    A sketch of frequent items, one for each task and merged, names candidates; these are counted exactly, which shuffles as many rows
    as there are candidates. A token that is no candidate occurs at most as often as the sketch says of the last candidate, or as its error allows. Where the last of the pool is not more frequent
    than that, a larger sketch is taken; where the largest does not tell them apart, all tokens are counted.
    """
    spark, ask = tokens.sparkSession, CANDIDATES * pool
    tracked = max(tracked, ask)
    while tracked <= MOST_TRACKED:
        seen = tokens.agg(F.count("token").alias("n"), F.expr(f"approx_top_k(token, {ask}, {tracked})").alias("top")).first()
        if not seen["n"]:
            return spark.createDataFrame([], "token string, n long")
        # ask rows
        named = spark.createDataFrame([(r["item"],) for r in seen["top"]], "token string")
        counts = tokens.join(F.broadcast(named), "token").groupBy("token").agg(F.count("*").alias("n"))
        best = counts.orderBy(F.desc("n"), "token").limit(pool)
        if len(seen["top"]) < ask and seen["n"] <= tracked:
            return best
        # the error of such a sketch: 3.5 of all for each place of a map that is filled to three quarters
        error = -(-(3.5 * 0.75 * seen["n"]) // tracked)
        last = best.agg(F.min("n"), F.count("*")).first()
        bound = max(error, seen["top"][-1]["count"] if len(seen["top"]) == ask else 0)
        if last[1] == pool and last[0] > bound:
            return best
        tracked, ask = 4 * tracked, 2 * ask
    return tokens.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(pool)


def prefix_counts(tokens: DataFrame, preferred: Sequence[str] = PREFERRED, pool: int = 200) -> DataFrame:
    """token, n of what top_prefixes asks for: the most frequent tokens, and the preferred ones that occur."""
    listed = tokens.where(F.col("token").isin(*preferred)).groupBy("token").agg(F.count("*").alias("n"))
    return most_frequent(tokens, pool).union(listed).distinct()


def top_prefixes(counts: DataFrame, preferred: Sequence[str] = PREFERRED, always: Sequence[str] = ALWAYS, limit: int = 80, pool: int = 200) -> DataFrame:
    """token, place: preferred ones that occur or are always listed, in their order; then tokens that occur twice or more, of the `pool` most frequent, until the limit."""
    spark = counts.sparkSession
    first = spark.createDataFrame([(t, i, t in always) for i, t in enumerate(preferred)], "token string, ord int, fixed boolean")
    present = first.join(counts, "token", "left").where(F.col("n").isNotNull() | F.col("fixed")).select("token", F.lit(0).alias("group"), F.col("ord").cast("long").alias("key"))
    most = counts.orderBy(F.desc("n"), "token").limit(pool)
    fill = most.join(present.select("token"), "token", "left_anti").where((F.col("n") >= 2) & F.col("token").rlike("^[a-z][a-z0-9+.-]*$")).select("token", F.lit(1).alias("group"), (-F.col("n")).alias("key"))
    # at most as many rows as are preferred and in the pool
    listed = present.union(fill).withColumn("place", F.row_number().over(Window.orderBy("group", "key", "token")))
    return listed.where((F.col("group") == 0) | (F.col("place") <= limit)).select("token", "place")


def pattern_lines(tokens: DataFrame) -> DataFrame:
    """pattern: an expression per token for texts that start with it."""
    safe = F.regexp_replace("token", r"([^A-Za-z0-9_])", r"\\\\$1")
    return tokens.select(F.concat(F.lit("re:^"), safe, F.lit(r"(?:\s|:|$)")).alias("pattern"))
