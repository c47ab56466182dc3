"""Price vocabularies and the text signals that override or qualify a price."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidar.functions.text import of_any_script

# Closed vocabularies of price types.
TRAINING_LINES = {
    "asking": "normal_listing", "normal_listing": "normal_listing",
    "reduced": "urgent_sale", "instant": "urgent_sale", "urgent_sale": "urgent_sale", "quick_sale": "urgent_sale", "instant_price": "urgent_sale",
    "verified_sale": "verified_sale",
}
ESTIMATOR_TYPES = {
    "asking": "normal_listing", "normal_listing": "normal_listing",
    "reduced": "urgent_sale", "urgent_sale": "urgent_sale", "instant": "urgent_sale", "quick_sale": "urgent_sale",
    "instant_price": "urgent_sale", "reduced_or_instant": "urgent_sale",
    "sold_last_ask": "last_public_price", "sold_explicit": "last_public_price", "last_public_price": "last_public_price",
    "verified_sale": "verified_sale", "buyout": "unknown",
}
URGENT_WORDS = ("急售", "急出")
URGENT_NEGATED = r"(?:不|非|不是|並非|并非)\s*急(?:售|出)"
BROKERAGE_WORD = "含仲"
PRICE_TERM = r"[0-9]+(?:\.[0-9]+)?\s*萬|[0-9]{3,}\s*(?:元|台幣|NTD)?"
INSTALLMENT = r"分期|分\s*(?:[0-9]+|[一二三四五六七八九十]+)\s*期"
SURCHARGE = r"(?:另加|加收|加價|加\s*價|超過\s*(?:一|1)\s*期\s*加|(?:分期|期付款)[^，。；;]{0,24}?加)\s*(?:NTD|台幣|元|\$)?\s*[0-9]+"
SALE_EXCHANGE = r"(?:售|出)\s*(?:／|/)\s*(?:換|换)|(?:換|换)\s*(?:／|/)\s*(?:售|出)"
URGENT_TYPES = ("asking", "normal_listing", "reduced", "instant", "instant_price", "quick_sale", "buyout")


def vocabulary(value: Column, words: dict[str, str], default: str = "unknown") -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(words.items())])
    return F.coalesce(F.try_element_at(table, value), F.lit(default))


def training_line(value: Column) -> Column:
    """The training line of a source price type; what no line knows is unknown."""
    return vocabulary(F.lower(F.trim(F.coalesce(value.cast("string"), F.lit("unknown")))), TRAINING_LINES)


def estimator_price_type(price_type: Column, sale_verified: Column, completed_price: Column) -> Column:
    """A verified sale with a completed price is one whatever its label; a claimed one is the last public price."""
    verified = F.coalesce(sale_verified, F.lit(False)) & completed_price.isNotNull()
    return F.when(verified, "verified_sale").otherwise(vocabulary(F.coalesce(price_type, F.lit("unknown")), ESTIMATOR_TYPES))


def urgent_claim(text: Column) -> Column:
    """An urgent sale is claimed once its negations are taken away."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), of_any_script(URGENT_NEGATED), "").rlike("|".join(URGENT_WORDS))


def urgent_override(price_type: Column, text: Column) -> Column:
    """A listing type whose text claims urgency is an urgent sale; claimed sales are sale claims whatever the text says."""
    known = F.lower(F.trim(F.coalesce(price_type, F.lit("unknown"))))
    line = F.when(known.isin("sold_explicit", "sold_last_ask"), "sold_claim").when(known == "asking", "normal_listing").otherwise(known)
    return F.when(urgent_claim(text) & known.isin(*URGENT_TYPES), "urgent_sale").otherwise(line)


def price_semantic_review(text: Column, price_type: Column) -> Column:
    """What keeps a price from being one cash price for one account: brokerage within it, or terms that
    give several prices. Null where nothing does; an amount is never chosen."""
    said = F.coalesce(text, F.lit(""))
    brokerage = said.contains(BROKERAGE_WORD)
    badges = said.contains("含勳章") & said.contains("不含勳章") & said.contains("分期") & (F.regexp_count(said, F.lit(of_any_script(PRICE_TERM))) >= 3)
    surcharge = said.rlike(of_any_script(INSTALLMENT)) & said.rlike("(?i)" + of_any_script(SURCHARGE))
    several = badges | surcharge
    codes = F.array_compact(F.array(
        F.when(brokerage, "brokerage_included_price"), F.when(several, "multiple_price_terms"),
        F.when(badges, "badge_inclusion_price_variants"), F.when(several, "installment_price_variants")))
    review = F.struct(
        F.when(price_type == "urgent_sale", "urgent_sale").otherwise("unknown").alias("urgency"), brokerage.alias("brokerage_included"), several.alias("multi_price"),
        F.lit("text_claim").alias("evidence_state"), F.lit("needs_review").alias("review_status"), codes.alias("reason_codes"))
    return F.when(brokerage | several, review)


def sale_and_exchange(text: Column) -> Column:
    """Cash and exchange offered together: a mixed offer, whose entity kind is unknown."""
    return F.coalesce(text, F.lit("")).rlike(of_any_script(SALE_EXCHANGE))
