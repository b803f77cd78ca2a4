"""Column functions of the payment-graph preparation; all built of JVM-side expressions."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = ""


def text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(BLANK))


def clean_text(c) -> Column:
    """Separator, tab, line breaks and backslash become spaces; ends are trimmed; null is empty."""
    return F.trim(F.translate(text(c), "|\t\n\r\\", "     "))


def boolean_text(c) -> Column:
    return F.when(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(False)), "true").otherwise("false")


def to_ms(c) -> Column:
    """Epoch seconds to milliseconds; unknown (null, zero or less) is 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, c * 1000).otherwise(0).cast("long")


def email_domain(c) -> Column:
    return F.when(F.instr(text(c), "@") == 0, BLANK).otherwise(F.lower(F.trim(F.split_part(text(c), F.lit("@"), F.lit(2)))))


def postal_prefix(c) -> Column:
    return F.left(F.regexp_replace(text(c), "[^A-Za-z0-9]", ""), F.lit(3))


def funding_account_id(card) -> Column:
    """The instrument behind a card id: the reissue suffix -G<n> goes. \\z, as $ would also match before a last line feed."""
    return F.regexp_replace(F.trim(text(card)), r"-G[0-9]+\z", "")


def card_generation(card) -> Column:
    """n of the suffix -G<n>, else 0. Not trimmed first: 'C1-G2 ' has generation 0."""
    return F.when(text(card).rlike(r"-G[0-9]+\z"), F.regexp_extract(text(card), r"-G([0-9]+)\z", 1).try_cast("int")).otherwise(0)


def instrument_type(card) -> Column:
    first = F.left(F.trim(text(card)), F.lit(1))
    return F.when(first == "C", "credit").when(first == "D", "debit").otherwise("unknown")


def epoch_of_text(c) -> Column:
    """Seconds since 1970 of a UTC timestamp text, rounded down, at least 0; null is 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.greatest(F.floor(F.unix_micros(c.try_cast("timestamp")) / 1_000_000), F.lit(0)), F.lit(0)).cast("long")


def utc_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd HH:mm:ss")


#: Spellings of party types.
PARTY_TYPES = {
    "individual": "individual",
    "person": "individual",
    "natural": "individual",
    "natural_person": "individual",
    "company": "company",
    "business": "company",
    "corporate": "company",
    "corporation": "company",
    "organisation": "company",
    "organization": "company",
    "legal_entity": "company",
    "merchant": "merchant_entity",
    "merchant_entity": "merchant_entity",
}


def vocabulary(c, words: dict[str, str], other: str = "unknown") -> Column:
    """Closed vocabulary: the word's meaning, case and outer spaces aside, or `other`."""
    key = F.lower(F.trim(text(c)))
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(other))


ONLINE, CHIP, SWIPE = "Online Transaction", "Chip Transaction", "Swipe Transaction"


def channel(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == ONLINE, "ecommerce").when(c.isin(CHIP, SWIPE), "pos").otherwise("unknown")


def entry_mode(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == ONLINE, "ecommerce").when(c == CHIP, "chip").when(c == SWIPE, "magstripe").otherwise("unknown")


def card_present(c) -> Column:
    """Null stays null, as an unknown way of use is neither."""
    return (F.col(c) if isinstance(c, str) else c).isin(CHIP, SWIPE)


def opaque_id(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(r"\A[patdih]_[0-9a-f]{32}\z")


def visible(start, end, seed) -> Column:
    """Half-open validity: from start, until before end; an end of 0 is open."""
    start, end, seed = (F.col(x) if isinstance(x, str) else F.lit(x) if isinstance(x, int) else x for x in (start, end, seed))
    return (start <= seed) & ((end == 0) | (seed < end))


@dataclass(frozen=True)
class TokenPolicy:
    """Keyed tokens of personal identifiers: HMAC-SHA-256 with a secret of 16 characters or more.

    The pads are computed once on the driver and stand in plans as literals, so plans and event
    logs must not be published. The salt itself is never part of a result; `digest` may be stored
    to find out later whether the same salt is in use.
    """

    salt: str = field(repr=False)
    hex_length: int = 32
    pinned_digest: str | None = None

    def __post_init__(self):
        if len(self.salt) < 16:
            raise ValueError("the salt needs 16 characters or more")
        if self.pinned_digest and self.pinned_digest != self.digest:
            raise ValueError("the salt is not the one these tokens were made with")

    @property
    def digest(self) -> str:
        return hashlib.sha256(b"salt digest:" + self.salt.encode("utf8")).hexdigest()

    def pads(self) -> tuple[bytes, bytes]:
        """Inner and outer pad: the key is the salt's SHA-256, filled up with zeros to 64 bytes."""
        key = hashlib.sha256(self.salt.encode("utf8")).digest() + bytes(32)
        return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)

    def token(self, kind: str, prefix: str, value) -> Column:
        """prefix_ and the first hex digits of the HMAC of 'kind:value'; kinds can't be joined with each other."""
        inner, outer = (F.lit(bytearray(p)) for p in self.pads())
        message = F.encode(F.concat(F.lit(f"{kind}:"), text(value)), "UTF-8")
        digest = lambda pad, data: F.unhex(F.sha2(F.concat(pad, data), 256))
        return F.concat(F.lit(f"{prefix}_"), F.left(F.lower(F.hex(digest(outer, digest(inner, message)))), F.lit(self.hex_length)))


@dataclass(frozen=True)
class LabelPolicy:
    """When a label counts as known: fraud some time after the event, clean once disputes have run out."""

    policy_id: str = "synthetic_v1"
    fraud_confirmation_delay_seconds: int = 30 * 86400
    maturation_window_seconds: int = 120 * 86400


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
