"""Card-fraud preparation: from source tables to vertex and edge datasets, as one lazy graph of frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora import functions as fn
from sequora.operators import entities as e
from sequora.operators import sequence as s
from sequora.operators import transactions as t
from sequora.operators.export import AT_ONCE, CORRUPT, read_export
from sequora.operators.relations import instrument_in_force
from sequora.sources.staging import staged

SOURCE_SYSTEM = "synthetic"


class Datasets(Mapping):
    """Frames by name in load order, each made when first asked for."""

    def __init__(self, made_by: dict[str, Callable[[], DataFrame]]):
        self.made_by, self.made = made_by, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.made_by[name]()
        return self.made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.made_by)

    def __len__(self) -> int:
        return len(self.made_by)

    def __or__(self, more: Mapping[str, DataFrame]) -> Datasets:
        """These, with others in their place or behind them."""
        return Datasets({n: lambda n=n: self[n] for n in self} | {n: lambda n=n: more[n] for n in more})


class once:  # noqa: N801
    """A property made when first asked for, once, also if several threads ask for it."""

    def __init__(self, make: Callable):
        self.make, self.name = make, make.__name__

    def __get__(self, p, kind=None):
        if p is None:
            return self
        with p.__dict__.setdefault(f"_making_{self.name}", Lock()):
            if self.name not in p.__dict__:
                p.__dict__[self.name] = self.make(p)
            return p.__dict__[self.name]


class CardFraud:
    """Every frame of the preparation, made when first asked for.

    `whole` stages each that a dataset is cut from, for exports and for audits that read all of them
    several times; `keep` those that many others read, for single audits; `clock` only the sequence, its
    bounds, and the payments where a query looks at them twice: single queries join these several times.
    """

    def __init__(self, tables: dict[str, DataFrame], tokens: fn.TokenPolicy, labels: fn.LabelPolicy = fn.LabelPolicy(), keep: bool = False, clock: bool = False, whole: bool = False):
        self.src, self.tokens, self.labels = tables, tokens, labels
        self.whole, self.keep, self.clock = whole, keep or whole, keep or clock or whole

    def _kept(self, df: DataFrame) -> DataFrame:
        return staged(df) if self.keep else df

    def _stored(self, df: DataFrame) -> DataFrame:
        return staged(df) if self.whole else df

    def stage(self, names: list[str] | None = None) -> CardFraud:
        """With `whole`, write what the datasets (or those named) are cut from, each frame once and those that wait for no other beside each other.

        The datasets themselves are selections of these frames and are not written.
        """
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(self.datasets.__getitem__, reversed(names or list(self.datasets))))  # payments take longest
        return self

    # the clock
    @once
    def sequence(self):
        rows = s.event_sequence(self.src["transaction"])
        return staged(rows) if self.clock else rows

    @once
    def limits(self):
        rows = s.bounds(self.sequence)
        return staged(rows) if self.clock else rows

    @once
    def card_seen(self):
        return self._kept(s.first_seen_of_events(self.src["card_edge"], "card_number", self.sequence))

    @once
    def merchant_seen(self):
        return self._kept(s.first_seen_of_events(self.src["merchant_edge"], "merchant_id", self.sequence))

    @once
    def account_seen(self):
        return self._stored(e.account_first_seen(self.card_seen))

    @once
    def party_seen(self):
        by_card = s.through(self.src["party_has_card"], "card_number", self.card_seen, "party_id")
        by_merchant = s.through(self.src["operator"], "merchant_id", self.merchant_seen, "party_id")
        return self._kept(s.first_seen_over("party_id", by_card, by_merchant))

    def _endpoint_seen(self, used: str, held: str, c: str):
        own = self.src[used].join(self.sequence, F.col("txn_id") == F.col("transaction_id")).select(c, F.col("unix_time").alias(s.FIRST[0]), F.col("event_seq").alias(s.FIRST[1]))
        return s.first_seen_over(c, own, s.through(self.src[held], "party_id", self.party_seen, c))

    @once
    def device_seen(self):
        return self._endpoint_seen("device_edge", "has_device", "device_id")

    @once
    def ip_seen(self):
        return self._endpoint_seen("ip_edge", "has_ip", "ip_id")

    # entities
    @once
    def card_account(self):
        return self._stored(e.card_account(self.src["card"]))

    @once
    def geography(self):
        return self._stored(e.merchant_geography(*(self.src[t] for t in ("merchant", "merchant_city", "merchant_state", "merchant_zip"))))

    @once
    def category(self):
        return self._stored(e.merchant_category(self.src["merchant_category"]))

    @once
    def homes(self):
        return e.party_home_area(self.src["party"], self.src["home_state"], self.src["home_zip"])

    @once
    def parties(self):
        return self._stored(e.parties(self.src["party"], self.party_seen, self.limits))

    @once
    def accounts(self):
        return self._stored(e.accounts(self.card_account, self.account_seen))

    @once
    def cards(self):
        return self._stored(e.cards(self.card_account, self.card_seen, self.limits))

    @once
    def merchants(self):
        return self._stored(e.merchants(self.src["merchant"], self.merchant_seen, self.category, self.geography, self.limits))

    @once
    def locations(self):
        return self._stored(e.merchant_locations(self.geography, self.src["merchant_coordinates"], self.merchant_seen))

    def _held(self, edges: str, c: str, kind: str, prefix: str):
        return e.held_values(self.src[edges], c, self.party_seen, self.limits, self.tokens.token(kind, prefix, "raw"))

    @once
    def emails(self):
        return self._stored(self._held("has_email", "email", "email", "eml").withColumn("domain", fn.clean_text(fn.email_domain("raw"))))

    @once
    def phones(self):
        return self._stored(self._held("has_phone", "phone_number", "phone", "phn").withColumns({"country_code": F.lit(""), "line_type": F.lit("unknown")}))

    @once
    def address_areas(self):
        return e.address_areas(self.src["has_address"], self.homes)

    @once
    def addresses(self):
        return self._stored(e.address_values(self._held("has_address", "address", "address", "adr"), self.address_areas))

    @once
    def documents(self):
        return self._stored(e.document_values(self._held("has_document", "id", "document", "doc"), self.src["document"]))

    @once
    def devices(self):
        d = e.endpoint_values(self.src["has_device"], self.src["device_edge"], "device_id", self.device_seen, self.limits, self.tokens.token("device", "dev", "raw"))
        return self._kept(d.withColumns({c: F.lit("unknown") for c in ("device_type", "os_family", "browser_family")}))

    @once
    def ips(self):
        d = e.endpoint_values(self.src["has_ip"], self.src["ip_edge"], "ip_id", self.ip_seen, self.limits, self.tokens.token("ip", "ip", "raw"))
        return self._kept(d.withColumns({"country_code": F.lit(""), "asn": F.lit(-1), "network_type": F.lit("unknown")}))

    # relations
    @once
    def party_owns_account(self):
        owned = self.src["party_has_card"].join(self.card_account, F.col("card_number") == F.col("card_id")).select("party_id", F.col("account_id").alias("_edge"))
        return self._stored(e.lower_bound(owned, "party_id", self.party_seen, self.account_seen.withColumn("raw", F.col("account_id")), "raw", "account_id"))

    @once
    def party_operates_merchant(self):
        edges = self.src["operator"].select("party_id", F.col("merchant_id").alias("_edge"))
        return self._stored(e.lower_bound(edges, "party_id", self.party_seen, self.merchant_seen.withColumn("raw", F.col("merchant_id")), "raw", "merchant_id"))

    @once
    def account_has_card(self):
        rows = e.account_has_card(self.card_account, self.card_seen, self.limits)
        return staged(rows) if self.clock else rows

    @once
    def merchant_has_location(self):
        return self.locations.select("merchant_id", "location_id", F.col("first_seen_event_seq").alias("valid_from_seq"), F.lit(0).cast("long").alias("valid_to_seq"))

    @once
    def party_values(self) -> Datasets:
        spec = {"email": ("has_email", "email", "emails", "email_id"), "phone": ("has_phone", "phone_number", "phones", "phone_id"), "address": ("has_address", "address", "addresses", "address_id"), "identity_document": ("has_document", "id", "documents", "document_id"), "device": ("has_device", "device_id", "devices", "device_token"), "ip": ("has_ip", "ip_id", "ips", "ip_token")}

        def relation(edges, c, values, name):
            found = e.party_value_relation(self.src[edges], c, getattr(self, values), self.party_seen, name)
            return self._stored(found.withColumnRenamed(name, name.replace("_token", "_id")))

        return Datasets({kind: lambda x=x: relation(*x) for kind, x in spec.items()})

    # payments
    @once
    def payments(self):
        return t.payments(self.src["transaction"], self.src["card_edge"], self.src["merchant_edge"], self.sequence, self.locations)

    @once
    def paid(self):
        """Who paid with what, and when: the manifest's rows without labels and places, for queries that look at them more than once."""
        rows = self.payments.select("transaction_id", "account_id", "card_id", "event_seq")
        return staged(rows) if self.clock else rows

    @once
    def manifest(self):
        return self._kept(t.manifest(self.payments, self.sequence, self.limits, self.labels))

    @once
    def used_device(self):
        return self._stored(t.endpoint_edges(self.src["device_edge"], "device_id", self.sequence, self.devices, "device_id"))

    @once
    def from_ip(self):
        return self._stored(t.endpoint_edges(self.src["ip_edge"], "ip_id", self.sequence, self.ips, "ip_id"))

    @once
    def in_force(self):
        return instrument_in_force(self.paid, self.account_has_card)

    # the datasets, in load order: vertices, relations, payments, their endpoints
    @once
    def datasets(self) -> Datasets:
        c, b, ms = fn.clean_text, fn.boolean_text, fn.to_ms
        seen = [F.col("first_seen_event_seq").alias("first_seen_seq"), ms("first_seen_unix_time").alias("first_seen_ts_ms")]

        def out(df, id_from, id_name, *columns):
            return df.select(c(id_from).alias(id_name), *seen, *columns)

        def edge(df, a, z):
            return df.select(c(a).alias(a), c(z).alias(z), "valid_from_seq", "valid_to_seq", F.lit(1.0).cast("float").alias("confidence"), F.lit(SOURCE_SYSTEM).alias("source_system"))

        clean = lambda *names: [c(n).alias(n) for n in names]
        m, v = (lambda: self.manifest), (lambda kind: self.party_values[kind])
        return Datasets({
            "01_parties": lambda: out(self.parties, "party_id", "party_id", ms("customer_since_unix_time").alias("customer_since_ts_ms"), *clean("party_type", "home_country")),
            "02_accounts": lambda: out(self.accounts, "account_id", "account_id", ms("opened_unix_time").alias("opened_ts_ms"), *clean("account_type", "base_currency", "country_code")),
            "03_cards": lambda: out(self.cards, "card_id", "card_id", ms("issued_unix_time").alias("issued_ts_ms"), *clean("card_type", "card_network", "card_product"), b("is_virtual").alias("is_virtual")),
            "04_merchants": lambda: out(self.merchants, "merchant_id", "merchant_id", ms("onboarded_unix_time").alias("onboarded_ts_ms"), *clean("merchant_category_code", "merchant_country", "merchant_type"), b("is_online").alias("is_online")),
            "05_merchant_locations": lambda: out(self.locations, "location_id", "location_id", *clean("country_code", "region_code", "postal_code_prefix"), "latitude", "longitude", b("has_coordinates").alias("has_coordinates")),
            "06_devices": lambda: out(self.devices, "id", "device_id", *clean("device_type", "os_family", "browser_family")),
            "07_ip_addresses": lambda: out(self.ips, "id", "ip_id", *clean("country_code"), "asn", *clean("network_type")),
            "08_emails": lambda: out(self.emails, "id", "email_id", *clean("domain")),
            "09_phones": lambda: out(self.phones, "id", "phone_id", *clean("country_code", "line_type")),
            "10_addresses": lambda: out(self.addresses, "id", "address_id", *clean("country_code", "region_code", "postal_code_prefix")),
            "11_identity_documents": lambda: out(self.documents, "id", "document_id", *clean("document_type", "issuing_country")),
            "12_party_owns_account": lambda: edge(self.party_owns_account, "party_id", "account_id"),
            "13_account_has_card": lambda: edge(self.account_has_card, "account_id", "card_id"),
            "14_party_has_email": lambda: edge(v("email"), "party_id", "email_id"),
            "15_party_has_phone": lambda: edge(v("phone"), "party_id", "phone_id"),
            "16_party_has_address": lambda: edge(v("address"), "party_id", "address_id"),
            "17_party_has_identity_document": lambda: edge(v("identity_document"), "party_id", "document_id"),
            "18_party_has_device": lambda: edge(v("device"), "party_id", "device_id"),
            "19_party_has_ip": lambda: edge(v("ip"), "party_id", "ip_id"),
            "20_party_operates_merchant": lambda: edge(self.party_operates_merchant, "party_id", "merchant_id"),
            "21_merchant_has_location": lambda: edge(self.merchant_has_location, "merchant_id", "location_id"),
            "22_transactions": lambda: m().select(
                *clean("transaction_id"), fn.utc_text("unix_time").alias("event_time"), ms("unix_time").alias("event_ts_ms"), "event_seq", "amount", b("amount_present").alias("amount_present"),
                *clean("currency", "transaction_type", "channel", "entry_mode"), *[b(x).alias(x) for x in ("card_present", "is_cross_border", "is_recurring")], *clean("merchant_category_code"),
                b("has_event_location").alias("has_event_location"), "event_latitude", "event_longitude", "device_risk_score", "ip_risk_score", "fraud_label", b("label_known").alias("label_known"), "label_available_seq",
                ms("label_available_unix_time").alias("label_available_ts_ms"), *clean("label_source", "account_id", "card_id", "merchant_id", "location_id"),
            ),
            "23_transaction_used_device": lambda: self.used_device.select(*clean("transaction_id", "device_id"), ms("unix_time").alias("event_ts_ms"), "event_seq"),
            "24_transaction_from_ip": lambda: self.from_ip.select(*clean("transaction_id", "ip_id"), ms("unix_time").alias("event_ts_ms"), "event_seq"),
        })

    @once
    def fan_out(self) -> dict[str, DataFrame]:
        return fanned_out(self.datasets["22_transactions"])


def fanned_out(rows: DataFrame) -> dict[str, DataFrame]:
    """Payment rows as a vertex and its participation edges; the place edge only where there is one."""
    ends = ("account_id", "card_id", "merchant_id", "location_id")
    out = {"Payment_Transaction": rows.drop(*ends)}
    for end, name in zip(ends, ("By_Account", "By_Card", "To_Merchant", "At_Location")):
        edge = rows.select("transaction_id", end, "event_ts_ms", "event_seq")
        out[name] = edge.where(F.col(end) != "") if end == "location_id" else edge
    return out


class Written:
    """The datasets of a published export as they stand in its files; lines that can't be read are apart."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.lines = read_export(spark, folder)

    @cached_property
    def datasets(self) -> Datasets:
        return Datasets({n: lambda df=df: df.where(F.col(CORRUPT).isNull()).drop(CORRUPT) for n, df in self.lines.items()})

    @cached_property
    def fan_out(self) -> dict[str, DataFrame]:
        return fanned_out(self.datasets["22_transactions"])

    @cached_property
    def corrupt(self) -> DataFrame:
        """Lines that no row could be made of (dataset, line)."""
        return reduce(DataFrame.unionByName, [df.where(F.col(CORRUPT).isNotNull()).select(F.lit(n).alias("dataset"), F.col(CORRUPT).alias("line")) for n, df in self.lines.items()])
