"""Country and advertising text to region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: country codes, region keywords, priority of the keywords ---
COUNTRY_TO_REGION = {
    "US": "US",
    "CA": "CA",
    "GB": "UK",
    "UK": "UK",
    "AU": "AU",
}
LEGACY_COUNTRY_TO_REGION = {
    "US": "US",
    "CA": "CA",
    "GB": "UK",
    "AU": "AU",
}
REGION_KEYWORDS = {
    "AU": ["AU", "AUS", "AUSTRALIA"],
    "UK": ["UK", "GB", "UNITEDKINGDOM"],
    "CA": ["CA", "CAN", "CANADA"],
    "US": ["US", "USA", "UNITEDSTATES"],
}
DEFAULT_REGION = "US"
# --- end of fixed values ---

# Entries of an account dictionary up to which its join is a broadcast; the result is the same beyond it.
BROADCAST_ROW_LIMIT = 100_000


def lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[key]


def region_of_country(country: Column) -> Column:
    return lookup(COUNTRY_TO_REGION, F.upper(country))


def region_of_country_legacy(country: Column) -> Column:
    return lookup(LEGACY_COUNTRY_TO_REGION, country)


def ad_tokens(*parts: Column) -> Column:
    """Upper-case alphanumeric words of the non-empty parts, as a set."""
    text = F.upper(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))
    return F.array_remove(F.array_distinct(F.split(text, r"[^\p{L}\p{N}]+")), "")


def region_of_text(parts: list[Column], keywords: dict[str, list[str]] = REGION_KEYWORDS) -> Column:
    """First region, in the order given, one of whose keywords is a token of the texts.

    One search per region for a keyword between non-alphanumeric characters; that is a third of
    the cost of splitting every text into its tokens.
    """
    text = F.upper(F.concat_ws(" ", *parts))
    chain = None
    for region, words in keywords.items():
        inner = "|".join(rf"\Q{w}\E" for w in words)
        hit = F.rlike(text, F.lit(rf"(?<![\p{{L}}\p{{N}}])(?:{inner})(?![\p{{L}}\p{{N}}])"))
        chain = F.when(hit, region) if chain is None else chain.when(hit, region)
    return chain


def with_ad_region(
    ads: DataFrame,
    account_regions: dict[str, str] | DataFrame | None = None,
    keywords: dict[str, list[str]] = REGION_KEYWORDS,
    text_columns: tuple[str, ...] = ("campaign_name", "adset_name", "ad_name"),
    account_column: str = "account_id",
) -> DataFrame:
    """Region by account, else by keywords in the ad texts, else the default.

    A dictionary of any size, or a table ``(account_id, region)`` with one row per account, is
    left-joined; an account with a blank region falls through to the texts. The join is a broadcast
    only when the number of entries is known to be small, else Spark sizes it at run time.
    """
    present = [F.col(c) for c in text_columns if c in ads.columns]
    by_text = region_of_text(present, keywords) if present else F.lit(None).cast("string")
    account = F.col(account_column)
    if not account_regions:
        by_account = F.lit(None).cast("string")
    else:
        by_account = F.nullif(F.col("_account_region"), F.lit(""))
        if isinstance(account_regions, dict):
            table = ads.sparkSession.createDataFrame(
                list(account_regions.items()), "_account string, _account_region string"
            )
            if len(account_regions) <= BROADCAST_ROW_LIMIT:
                table = F.broadcast(table)
        else:
            table = account_regions.select(
                F.col(account_regions.columns[0]).alias("_account"),
                F.col(account_regions.columns[1]).alias("_account_region"),
            )
        ads = ads.join(table, account == F.col("_account"), "left").drop("_account")
    return ads.withColumn("region", F.coalesce(by_account, by_text, F.lit(DEFAULT_REGION))).drop("_account_region")
