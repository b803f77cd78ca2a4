"""Declared tables: source columns of the card-fraud use case, datasets of the temporal use case."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns read of each source table; all are text.
SOURCE_COLUMNS = {
    "transaction": "id transaction_time amount is_fraud unix_time mer_cat use_chip",
    "card_edge": "txn_id card_number edge_unix_time",
    "merchant_edge": "txn_id merchant_id edge_unix_time",
    "device_edge": "txn_id device_id edge_unix_time",
    "ip_edge": "txn_id ip_id edge_unix_time",
    "card": "card_number",
    "merchant": "id",
    "party": "id party_type created_at",
    "party_has_card": "party_id card_number",
    "operator": "merchant_id party_id",
    "merchant_category": "merchant_id category",
    "merchant_coordinates": "merchant_id lat lon",
    "merchant_city": "merchant_id city_id",
    "merchant_state": "merchant_id state_id",
    "merchant_zip": "merchant_id zipcode_id",
    "home_state": "party_id state_id since_unix_time",
    "home_zip": "party_id zipcode_id since_unix_time",
    "email": "email",
    "phone": "phone_number",
    "address": "address",
    "document": "id id_type",
    "device": "id",
    "ip": "id",
    "has_email": "party_id email",
    "has_phone": "party_id phone_number",
    "has_address": "party_id address",
    "has_document": "party_id id",
    "has_device": "party_id device_id",
    "has_ip": "party_id ip_id",
}
SOURCE_COLUMNS = {t: c.split() for t, c in SOURCE_COLUMNS.items()}
CORE_TABLES = ("transaction", "card_edge", "merchant_edge", "card", "merchant", "party")
OPTIONAL_TABLES = ("device_edge", "ip_edge")
#: Columns that are protected, or known only when the payment was answered.
PROTECTED = ("name", "gender", "dob", "error", "is_blocked")
#: Names that no output dataset may have.
FORBIDDEN = tuple("email email_raw phone_number phone_raw address address_raw device_raw ip_raw document_raw name gender dob birthdate full_name split_id causal_fold error is_blocked is_online_txn label_resolution_status".split())
#: Supervision columns, never features.
SUPERVISION = tuple("fraud_label label_known label_available_seq label_available_ts_ms label_source is_mule mule_label_known is_mule_masked pu_label mule_label_effective_seq mule_label_effective_ts_ms mule_label_available_seq mule_label_available_ts_ms mule_ring_id mule_label_source".split())

#: Declared types, and what they are in Spark.
SPARK_TYPES = {"STRING": T.StringType(), "UINT": T.DecimalType(20, 0), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(), "BOOL": T.BooleanType(), "DATETIME": T.TimestampNTZType(), "LIST<DOUBLE>": T.ArrayType(T.DoubleType())}


class Ends(NamedTuple):
    """Where the edges of a table lead, and what they are called backwards."""

    source: str
    target: str
    reverse: str


class Table(NamedTuple):
    """A declared table: what its rows are, its Spark schema, and its ends if rows are edges.

    A field's metadata say how it is declared; `empty_for_null` that a null stands for an empty text,
    `added_later` that a store keeps it behind the fields it began with.
    """

    name: str
    role: str  # entity, event, association or participation
    schema: T.StructType
    ends: Ends | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def key(self) -> str:
        return self.schema[0].name


def declared(field: T.StructField) -> str:
    return field.metadata["declared"]


def _schema(empty_for_null: str = "", added_later: str = "", **types: str) -> T.StructType:
    marks = lambda n: {k: True for k, marked in (("empty_for_null", empty_for_null), ("added_later", added_later)) if n == marked}
    return T.StructType([T.StructField(n, SPARK_TYPES[t], True, {"declared": t, **marks(n)}) for n, t in types.items()])


# Fixed values from here on: the 27 tables of the temporal use case, columns in order.
_SEEN = {"first_seen_seq": "UINT", "first_seen_ts_ms": "UINT"}
_LABEL = {"mule_label_effective_seq": "UINT", "mule_label_effective_ts_ms": "UINT", "mule_label_available_seq": "UINT", "mule_label_available_ts_ms": "UINT", "mule_ring_id": "INT", "mule_label_source": "STRING"}
ENTITY_SCHEMAS = {
    "Party": _schema(id="STRING", party_type="STRING", **_SEEN),
    "Account": _schema("mule_label_source", "is_mule", id="STRING", account_type="STRING", is_external="BOOL", **_SEEN, is_mule="INT", mule_label_known="BOOL", is_mule_masked="BOOL", pu_label="INT", **_LABEL),
    "Token": _schema(token_id="STRING", **_SEEN, token_kind="STRING", token_network="STRING"),
    "Device": _schema(id="STRING", device_type="STRING", **_SEEN),
    "IP": _schema(id="STRING", **_SEEN),
    "Address": _schema(address_id="STRING", **_SEEN, country_code="STRING"),
}
EVENT_SCHEMAS = {
    "Payment_Transaction": _schema(transaction_id="STRING", amount="DOUBLE", currency="STRING", payment_rail="STRING", channel="STRING", event_time="DATETIME", event_ts_ms="UINT", event_seq="UINT", amount_present="BOOL"),
    "Zelle_Transfer": _schema(transfer_id="STRING", event_time="DATETIME", event_ts_ms="UINT", event_seq="UINT", amount="DOUBLE", amount_present="BOOL", currency="STRING", channel="STRING", fraud_label="INT", label_known="BOOL", label_available_seq="UINT", label_available_ts_ms="UINT"),
}
TENURE_SCHEMA = _schema(from_id="STRING", to_id="STRING", valid_from_seq="UINT", valid_to_seq="UINT", confidence="FLOAT", source_system="STRING")
TENURES = {
    "Party_Owns_Account": Ends("Party", "Account", "Account_Owned_By_Party"),
    "Party_Uses_Token": Ends("Party", "Token", "Token_Used_By_Party"),
    "Token_Bound_To_Account": Ends("Token", "Account", "Account_Bound_From_Token"),
    "Party_Uses_Device": Ends("Party", "Device", "Device_Used_By_Party"),
    "Account_Uses_Device": Ends("Account", "Device", "Device_Used_By_Account"),
    "Party_Uses_IP": Ends("Party", "IP", "IP_Used_By_Party"),
    "Party_Has_Address": Ends("Party", "Address", "Address_Used_By_Party"),
}
PARTICIPATION_SCHEMA = _schema(from_id="STRING", to_id="STRING", event_ts_ms="UINT", event_seq="UINT")
#: What an event's participations begin with, by event table.
TAKES_PART = {"Zelle_Transfer": "Transfer", "Payment_Transaction": "Transaction"}
PARTICIPATIONS = {
    "Transfer_From_Account": Ends("Zelle_Transfer", "Account", "Account_Sent_Zelle_Transfer"),
    "Transfer_To_Account": Ends("Zelle_Transfer", "Account", "Account_Received_Zelle_Transfer"),
    "Transfer_From_Token": Ends("Zelle_Transfer", "Token", "Token_Sent_Transfer"),
    "Transfer_To_Token": Ends("Zelle_Transfer", "Token", "Token_Received_Transfer"),
    "Transfer_Used_Device": Ends("Zelle_Transfer", "Device", "Device_Used_By_Transfer"),
    "Transfer_Used_IP": Ends("Zelle_Transfer", "IP", "IP_Used_By_Transfer"),
    "Transaction_From_Account": Ends("Payment_Transaction", "Account", "Account_Initiated_Transaction"),
    "Transaction_To_Account": Ends("Payment_Transaction", "Account", "Account_Received_Transaction"),
    "Transaction_From_Token": Ends("Payment_Transaction", "Token", "Token_Sent_Transaction"),
    "Transaction_To_Token": Ends("Payment_Transaction", "Token", "Token_Received_Transaction"),
    "Transaction_Used_Device": Ends("Payment_Transaction", "Device", "Device_Used_By_Transaction"),
    "Transaction_Used_IP": Ends("Payment_Transaction", "IP", "IP_Observed_In_Transaction"),
}
#: Attributes of both event tables that the store has and no load fills.
KEPT_DEFAULTS = _schema(pair_delta_t_ms="UINT", pair_delta_t_present="BOOL", pair_time_encoding="LIST<DOUBLE>", time_encoding_basis_id="STRING", pair_previous_event_id="STRING", pair_sender_id="STRING", pair_recipient_type="STRING", pair_recipient_id="STRING")
# End of fixed values.
DEFAULTS = {"UINT": 0, "BOOL": False, "LIST<DOUBLE>": [], "STRING": ""}
BY_NAME = {t.name: t for t in [
    *[Table(n, "entity", s) for n, s in ENTITY_SCHEMAS.items()],
    *[Table(n, "event", s) for n, s in EVENT_SCHEMAS.items()],
    *[Table(n, "association", TENURE_SCHEMA, e) for n, e in TENURES.items()],
    *[Table(n, "participation", PARTICIPATION_SCHEMA, e) for n, e in PARTICIPATIONS.items()],
]}
DATASETS = list(BY_NAME.values())


class ContractError(ValueError):
    pass


def stored_fields(d: Table) -> list[T.StructField]:
    """Fields as a store keeps them: those that were added later behind the others, and last those that no load fills, with their default in the metadata."""
    own = sorted(d.schema, key=lambda f: f.metadata.get("added_later", False))
    more = [T.StructField(f.name, f.dataType, True, f.metadata | {"kept_default": str(DEFAULTS[declared(f)]).lower()}) for f in KEPT_DEFAULTS] if d.role == "event" else []
    return [*own, *more]


def stored(d: Table, df: DataFrame) -> DataFrame:
    """A typed frame in the order of the store, with the defaults of what isn't loaded."""
    filled = {f.name: F.lit(DEFAULTS[declared(f)]).cast(f.dataType) for f in KEPT_DEFAULTS} if d.role == "event" else {}
    return df.withColumns(filled).select(*[f.name for f in stored_fields(d)]) if filled else df.select(*[f.name for f in stored_fields(d)])


def load_order(found: DataFrame, order: list[str], needs: dict[str, list[str]]) -> DataFrame:
    """For each found dataset (dataset, rows) and each one it needs: whether that one comes before it in `order`. Names beyond the order never do."""
    at = {n: k for k, n in enumerate(order)}
    pairs = [(d, n, n in at and d in at and at[n] < at[d]) for d, of in needs.items() for n in of]
    return found.join(found.sparkSession.createDataFrame(pairs, "dataset string, needs string, fits boolean"), "dataset").select("dataset", "needs", "rows", "fits")


class Description(NamedTuple):
    """What a store says of one of its types: attributes in order, ends and reverse name of edges, whether the key is an attribute, what tells edges of a pair apart."""

    attributes: list[tuple[str, str]]
    ends: Ends | None = None
    key_is_attribute: bool = False
    told_apart_by: tuple[str, ...] = ()


def described(d: Table) -> Description:
    fields = [(f.name, declared(f)) for f in stored_fields(d)]
    if d.ends:
        return Description(fields[2:], d.ends, False, ("valid_from_seq",) if d.role == "association" else ())
    return Description(fields, None, True)


def schema_faults(found: dict[str, Description], permitted: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """Where a store's types differ from the contract, as (type, fault); types that are neither declared, a reverse, nor permitted are faults."""
    reverses = {d.ends.reverse for d in DATASETS if d.ends}
    out = [(n, "not declared") for n in sorted(set(found) - set(BY_NAME) - reverses - set(permitted))]
    for d in DATASETS:
        have, want = found.get(d.name), described(d)
        if have is None:
            out.append((d.name, "missing"))
            continue
        names = (("attributes", "attributes, their types or order"), ("ends", "ends or reverse"), ("key_is_attribute", "key as attribute"), ("told_apart_by", "what tells edges apart"))
        out += [(d.name, text) for field, text in names if getattr(have, field) != getattr(want, field)]
    return out


def check_tables(tables: dict[str, DataFrame], required: dict[str, list[str]] = SOURCE_COLUMNS) -> None:
    """Raise for the first table that is missing, then for the first that lacks columns."""
    for name in required:
        if name not in tables:
            raise ContractError(f"missing table {name}")
    for name, columns in required.items():
        if lacking := [c for c in columns if c not in tables[name].columns]:
            raise ContractError(f"{name} lacks {', '.join(lacking)}")


def check_ordered(d: Table, df: DataFrame) -> None:
    if df.columns != d.columns:
        raise ContractError(f"{d.name} must have the columns {d.columns}, found {df.columns}")


def check_schema(d: Table, df: DataFrame) -> None:
    """Names, order and types of a written dataset; nothing more, nothing less."""
    want, have = [(f.name, f.dataType) for f in d.schema], [(f.name, f.dataType) for f in df.schema]
    if want != have:
        raise ContractError(f"{d.name}: expected {want}, found {have}")


def features_only(df: DataFrame) -> DataFrame:
    """Refuse a feature frame that has supervision columns."""
    if bad := [c for c in df.columns if c in SUPERVISION]:
        raise ContractError(f"supervision columns among features: {', '.join(bad)}")
    return df


def without_supervision(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in SUPERVISION])


def protected_columns(tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    return [(t, c) for t in sorted(tables) for c in tables[t].columns if c in PROTECTED]
