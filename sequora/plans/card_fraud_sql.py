"""The card-fraud frames in DuckDB's SQL, written from the definitions and not from the frames' code."""

from __future__ import annotations

import re

from sequora.functions import PARTY_TYPES, LabelPolicy, TokenPolicy
from sequora.sources.projection import SQL as SOURCES

P = LabelPolicy()


def clean(c: str) -> str:
    return f"trim(translate(coalesce({c},''), '|'||chr(9)||chr(10)||chr(13)||chr(92), '     '))"


def ms(c: str) -> str:
    return f"(CASE WHEN {c}>0 THEN {c}*1000 ELSE 0 END)::BIGINT"


def boolean(c: str) -> str:
    return f"CASE WHEN coalesce({c},false) THEN 'true' ELSE 'false' END"


def token(policy: TokenPolicy, kind: str, prefix: str, c: str) -> str:
    inner, outer = (f"from_hex('{p.hex()}')" for p in policy.pads())
    return f"'{prefix}_'||left(sha256({outer} || from_hex(sha256({inner} || encode('{kind}:'||coalesce({c},''))))),{policy.hex_length})"


def ctes(policy: TokenPolicy) -> dict[str, str]:
    account = "regexp_replace(trim(coalesce({0},'')), '-G[0-9]+$', '')"
    stamps = "min(first_seen_unix_time) first_seen_unix_time, min(first_seen_event_seq) first_seen_event_seq"
    floor = "coalesce(k.first_seen_event_seq, (SELECT minimum_event_seq FROM limits)) first_seen_event_seq, coalesce(k.first_seen_unix_time, (SELECT minimum_epoch FROM limits)) first_seen_unix_time"
    out = dict(SOURCES)
    out |= {
        "sequence": "SELECT id transaction_id, unix_time, row_number() OVER (ORDER BY unix_time, id) event_seq FROM transaction",
        "limits": "SELECT min(unix_time) minimum_epoch, max(unix_time) maximum_epoch, min(event_seq) minimum_event_seq, max(event_seq) maximum_event_seq, count(*) transaction_count FROM sequence",
        "card_seen": "SELECT card_number, min(unix_time) first_seen_unix_time, min(event_seq) first_seen_event_seq FROM card_edge JOIN sequence ON transaction_id=txn_id GROUP BY 1",
        "merchant_seen": "SELECT merchant_id, min(unix_time) first_seen_unix_time, min(event_seq) first_seen_event_seq FROM merchant_edge JOIN sequence ON transaction_id=txn_id GROUP BY 1",
        "account_seen": f"SELECT {account.format('card_number')} account_id, {stamps} FROM card_seen GROUP BY 1",
        "party_seen": f"SELECT party_id, {stamps} FROM (SELECT party_id, first_seen_unix_time, first_seen_event_seq FROM party_has_card JOIN card_seen USING (card_number) UNION ALL SELECT party_id, first_seen_unix_time, first_seen_event_seq FROM operator JOIN merchant_seen USING (merchant_id)) GROUP BY 1",
        "device_seen": f"SELECT device_id, {stamps} FROM (SELECT device_id, unix_time first_seen_unix_time, event_seq first_seen_event_seq FROM device_edge JOIN sequence ON transaction_id=txn_id UNION ALL SELECT device_id, first_seen_unix_time, first_seen_event_seq FROM has_device JOIN party_seen USING (party_id)) GROUP BY 1",
        "ip_seen": f"SELECT ip_id, {stamps} FROM (SELECT ip_id, unix_time first_seen_unix_time, event_seq first_seen_event_seq FROM ip_edge JOIN sequence ON transaction_id=txn_id UNION ALL SELECT ip_id, first_seen_unix_time, first_seen_event_seq FROM has_ip JOIN party_seen USING (party_id)) GROUP BY 1",
        "card_account": f"SELECT card_number card_id, {account.format('card_number')} account_id, CASE WHEN regexp_matches(card_number,'-G[0-9]+$') THEN regexp_extract(card_number,'-G([0-9]+)$',1)::INT ELSE 0 END generation, CASE left(trim(card_number),1) WHEN 'C' THEN 'credit' WHEN 'D' THEN 'debit' ELSE 'unknown' END instrument_type FROM card",
        "geography": "SELECT m.id merchant_id, count(DISTINCT city_id) city_count, min(city_id) city_id, count(DISTINCT state_id) state_count, min(state_id) state_id, count(DISTINCT zipcode_id) zipcode_count, min(zipcode_id) zipcode_id FROM merchant m LEFT JOIN merchant_city c ON c.merchant_id=m.id LEFT JOIN merchant_state s ON s.merchant_id=m.id LEFT JOIN merchant_zip z ON z.merchant_id=m.id GROUP BY 1",
        "online": "SELECT merchant_id, NOT (city_id IS NOT NULL AND state_id IS NOT NULL AND zipcode_id IS NOT NULL) is_online FROM geography",
        "category": "SELECT merchant_id, count(DISTINCT category) category_count, min(category) category FROM merchant_category GROUP BY 1",
        "homes_of": "SELECT id party_id, (SELECT state_id FROM home_state h WHERE h.party_id=p.id ORDER BY since_unix_time, state_id LIMIT 1) state_id, (SELECT zipcode_id FROM home_zip h WHERE h.party_id=p.id ORDER BY since_unix_time, zipcode_id LIMIT 1) zipcode_id, (SELECT count(DISTINCT zipcode_id) FROM home_zip h WHERE h.party_id=p.id) postcode_tenure_count, (SELECT count(DISTINCT state_id) FROM home_state h WHERE h.party_id=p.id) state_tenure_count FROM party p",
        "parties": f"SELECT p.id party_id, {floor}, CASE WHEN created_at IS NULL THEN 0 ELSE greatest(floor(epoch(created_at::TIMESTAMP)),0) END::BIGINT customer_since_unix_time, coalesce(MAP {{{', '.join(f"'{a}': '{b}'" for a, b in PARTY_TYPES.items())}}}[lower(trim(coalesce(party_type,'')))], 'unknown') party_type, '' home_country, k.party_id IS NULL first_seen_is_floor FROM party p LEFT JOIN party_seen k ON k.party_id=p.id",
        "accounts": "SELECT account_id, first_seen_event_seq, first_seen_unix_time, 0::BIGINT opened_unix_time, min(instrument_type) account_type, '' base_currency, '' country_code FROM card_account JOIN account_seen USING (account_id) GROUP BY ALL",
        "cards": f"SELECT c.card_id, {floor}, 0::BIGINT issued_unix_time, instrument_type card_type, 'unknown' card_network, 'unknown' card_product, false is_virtual, k.card_number IS NULL first_seen_is_floor FROM card_account c LEFT JOIN card_seen k ON k.card_number=c.card_id",
        "merchants": f"SELECT m.id merchant_id, {floor}, 0::BIGINT onboarded_unix_time, {clean('category')} merchant_category_code, '' merchant_country, 'unknown' merchant_type, coalesce(is_online,true) is_online, k.merchant_id IS NULL first_seen_is_floor FROM merchant m LEFT JOIN merchant_seen k ON k.merchant_id=m.id LEFT JOIN category c ON c.merchant_id=m.id LEFT JOIN online o ON o.merchant_id=m.id",
        "locations": f"SELECT g.merchant_id, g.merchant_id||'@'||zipcode_id location_id, '' country_code, {clean('state_id')} region_code, left(regexp_replace(zipcode_id,'[^A-Za-z0-9]','','g'),3) postal_code_prefix, coalesce(lat,0)::DOUBLE latitude, coalesce(lon,0)::DOUBLE longitude, c.merchant_id IS NOT NULL has_coordinates, k.first_seen_unix_time, k.first_seen_event_seq FROM geography g LEFT JOIN merchant_coordinates c ON c.merchant_id=g.merchant_id JOIN merchant_seen k ON k.merchant_id=g.merchant_id WHERE city_id IS NOT NULL AND state_id IS NOT NULL AND zipcode_id IS NOT NULL",
        "areas": "SELECT address, count(DISTINCT (state_id, zipcode_id)) areas, min(state_id) state_id, min(zipcode_id) zipcode_id FROM has_address JOIN homes_of USING (party_id) WHERE state_id IS NOT NULL OR zipcode_id IS NOT NULL GROUP BY 1",
        "account_has_card": "SELECT account_id, card_id, v valid_from_seq, (CASE WHEN n>v THEN n ELSE 0 END)::BIGINT valid_to_seq FROM (SELECT *, lead(v) OVER (PARTITION BY account_id ORDER BY generation, card_id) n FROM (SELECT c.*, coalesce(first_seen_event_seq, (SELECT minimum_event_seq FROM limits)) v FROM card_account c LEFT JOIN card_seen ON card_number=card_id))",
        "party_owns_account": "SELECT DISTINCT o.party_id, c.account_id, greatest(p.first_seen_event_seq, a.first_seen_event_seq) valid_from_seq, 0::BIGINT valid_to_seq FROM party_has_card o JOIN card_account c ON c.card_id=o.card_number JOIN account_seen a ON a.account_id=c.account_id JOIN party_seen p ON p.party_id=o.party_id",
        "party_operates_merchant": "SELECT DISTINCT o.party_id, o.merchant_id, greatest(p.first_seen_event_seq, m.first_seen_event_seq) valid_from_seq, 0::BIGINT valid_to_seq FROM operator o JOIN party_seen p ON p.party_id=o.party_id JOIN merchant_seen m ON m.merchant_id=o.merchant_id",
        "merchant_has_location": "SELECT merchant_id, location_id, first_seen_event_seq valid_from_seq, 0::BIGINT valid_to_seq FROM locations",
    }
    for name, edges, c, kind, prefix, extra in (("emails", "has_email", "email", "email", "eml", f", {clean('CASE WHEN contains(v.raw, chr(64)) THEN lower(trim(split_part(v.raw, chr(64), 2))) ELSE chr(32) END')} AS domain"), ("phones", "has_phone", "phone_number", "phone", "phn", ", '' country_code, 'unknown' line_type"), ("addresses0", "has_address", "address", "address", "adr", ""), ("documents0", "has_document", "id", "document", "doc", "")):
        out[name] = f"SELECT v.raw, {token(policy, kind, prefix, 'v.raw')} id, {floor}{extra} FROM (SELECT DISTINCT {c} raw FROM {edges} WHERE trim(coalesce({c},''))<>'') v LEFT JOIN (SELECT {c} kk, {stamps} FROM {edges} JOIN party_seen USING (party_id) GROUP BY 1) k ON k.kk=v.raw"
    one = "CASE WHEN coalesce(areas,0)=1 THEN {0} ELSE '' END"
    out["addresses"] = f"SELECT raw, id, '' country_code, {one.format(clean('state_id'))} region_code, {one.format('left(regexp_replace(zipcode_id,$$[^A-Za-z0-9]$$,$$$$,$$g$$),3)')} postal_code_prefix, coalesce(areas,0) distinct_area_count, first_seen_unix_time, first_seen_event_seq FROM addresses0 LEFT JOIN areas ON address=raw"
    out["documents"] = f"SELECT d.raw, d.id, {clean('lower(trim(coalesce(r.id_type,$$unknown$$)))')} document_type, '' issuing_country, first_seen_unix_time, first_seen_event_seq FROM documents0 d LEFT JOIN document r ON r.id=d.raw"
    for name, c, kind, prefix, extra in (("devices", "device_id", "device", "dev", "'unknown' device_type, 'unknown' os_family, 'unknown' browser_family"), ("ips", "ip_id", "ip", "ip", "'' country_code, -1 asn, 'unknown' network_type")):
        base = "device" if name == "devices" else "ip"
        out[name] = f"SELECT v.raw, {token(policy, kind, prefix, 'v.raw')} id, {floor}, held_by_party, used_by_transaction, {extra} FROM (SELECT raw, bool_or(h) held_by_party, bool_or(NOT h) used_by_transaction FROM (SELECT {c} raw, true h FROM has_{base} UNION ALL SELECT {c}, false FROM {base}_edge) WHERE trim(coalesce(raw,''))<>'' GROUP BY 1) v LEFT JOIN {base}_seen k ON k.{c}=v.raw"
    for name, edges, c, values, id in (("party_has_email", "has_email", "email", "emails", "email_id"), ("party_has_phone", "has_phone", "phone_number", "phones", "phone_id"), ("party_has_address", "has_address", "address", "addresses", "address_id"), ("party_has_identity_document", "has_document", "id", "documents", "document_id"), ("party_has_device", "has_device", "device_id", "devices", "device_id"), ("party_has_ip", "has_ip", "ip_id", "ips", "ip_id")):
        out[name] = f"SELECT DISTINCT e.party_id, v.id {id}, greatest(p.first_seen_event_seq, v.first_seen_event_seq) valid_from_seq, 0::BIGINT valid_to_seq FROM {edges} e JOIN {values} v ON v.raw=e.{c} JOIN party_seen p ON p.party_id=e.party_id"
    out["label"] = f"SELECT s.transaction_id, s.unix_time, is_fraud fraud_label, (is_fraud=1 OR unix_ripe<=(SELECT maximum_epoch FROM limits)) label_known, (CASE WHEN is_fraud=1 THEN s.unix_time+{P.fraud_confirmation_delay_seconds} WHEN unix_ripe<=(SELECT maximum_epoch FROM limits) THEN unix_ripe ELSE 0 END)::BIGINT label_available_unix_time FROM (SELECT *, unix_time+{P.maturation_window_seconds} unix_ripe FROM sequence) s JOIN transaction t ON t.id=s.transaction_id"
    out["by_time"] = "SELECT unix_time, max(event_seq) latest_event_seq FROM sequence GROUP BY 1"
    out["label_seq"] = f"SELECT l.*, (CASE WHEN label_known THEN coalesce(b.latest_event_seq,0)+1 ELSE 0 END)::BIGINT label_available_seq, CASE WHEN label_known THEN '{P.policy_id}' ELSE '' END label_source FROM label l ASOF LEFT JOIN by_time b ON l.label_available_unix_time>=b.unix_time"
    use = "CASE use_chip WHEN 'Online Transaction' THEN 'ecommerce' WHEN 'Chip Transaction' THEN '{0}' WHEN 'Swipe Transaction' THEN '{1}' ELSE 'unknown' END"
    present = "use_chip IN ('Chip Transaction','Swipe Transaction')"
    shown = f"coalesce({present} AND has_coordinates, false)"
    out["manifest"] = f"SELECT t.id transaction_id, s.unix_time, s.event_seq, t.amount::DOUBLE amount, t.amount IS NOT NULL amount_present, '' currency, 'purchase' transaction_type, {use.format('pos', 'pos')} channel, {use.format('chip', 'magstripe')} entry_mode, {present} card_present, false is_cross_border, false is_recurring, {clean('mer_cat')} merchant_category_code, {shown} has_event_location, CASE WHEN {shown} THEN latitude ELSE 0 END event_latitude, CASE WHEN {shown} THEN longitude ELSE 0 END event_longitude, -1.0::DOUBLE device_risk_score, -1.0::DOUBLE ip_risk_score, l.fraud_label, l.label_known, l.label_available_unix_time, l.label_available_seq, l.label_source, c.card_number card_id, {account.format('c.card_number')} account_id, m.merchant_id, g.location_id FROM transaction t JOIN sequence s ON s.transaction_id=t.id JOIN card_edge c ON c.txn_id=t.id JOIN merchant_edge m ON m.txn_id=t.id JOIN label_seq l ON l.transaction_id=t.id LEFT JOIN locations g ON g.merchant_id=m.merchant_id"
    out["used_device"] = "SELECT e.txn_id transaction_id, v.id device_id, unix_time, event_seq FROM device_edge e JOIN sequence ON transaction_id=e.txn_id JOIN devices v ON v.raw=e.device_id"
    out["from_ip"] = "SELECT e.txn_id transaction_id, v.id ip_id, unix_time, event_seq FROM ip_edge e JOIN sequence ON transaction_id=e.txn_id JOIN ips v ON v.raw=e.ip_id"
    out["in_force"] = "SELECT m.transaction_id, m.account_id, m.event_seq seed_seq, m.card_id used_card_id, t.card_id, t.valid_from_seq, t.valid_to_seq FROM manifest m JOIN account_has_card t ON t.account_id=m.account_id AND t.valid_from_seq<=m.event_seq AND (t.valid_to_seq=0 OR m.event_seq<t.valid_to_seq)"
    seen = f"first_seen_event_seq first_seen_seq, {ms('first_seen_unix_time')} first_seen_ts_ms"
    cl = lambda *names: ", ".join(f"{clean(n)} AS {n}" for n in names)
    bo = lambda *names: ", ".join(f"{boolean(n)} AS {n}" for n in names)
    edge = lambda t, a, z: f"SELECT {cl(a, z)}, valid_from_seq, valid_to_seq, 1.0::FLOAT confidence, 'synthetic' source_system FROM {t}"
    out |= {
        "d01_parties": f"SELECT {cl('party_id')}, {seen}, {ms('customer_since_unix_time')} customer_since_ts_ms, {cl('party_type', 'home_country')} FROM parties",
        "d02_accounts": f"SELECT {cl('account_id')}, {seen}, {ms('opened_unix_time')} opened_ts_ms, {cl('account_type', 'base_currency', 'country_code')} FROM accounts",
        "d03_cards": f"SELECT {cl('card_id')}, {seen}, {ms('issued_unix_time')} issued_ts_ms, {cl('card_type', 'card_network', 'card_product')}, {bo('is_virtual')} FROM cards",
        "d04_merchants": f"SELECT {cl('merchant_id')}, {seen}, {ms('onboarded_unix_time')} onboarded_ts_ms, {cl('merchant_category_code', 'merchant_country', 'merchant_type')}, {bo('is_online')} FROM merchants",
        "d05_merchant_locations": f"SELECT {cl('location_id')}, {seen}, {cl('country_code', 'region_code', 'postal_code_prefix')}, latitude, longitude, {bo('has_coordinates')} FROM locations",
        "d06_devices": f"SELECT id device_id, {seen}, {cl('device_type', 'os_family', 'browser_family')} FROM devices",
        "d07_ip_addresses": f"SELECT id ip_id, {seen}, country_code, asn, network_type FROM ips",
        "d08_emails": f"SELECT id email_id, {seen}, domain FROM emails",
        "d09_phones": f"SELECT id phone_id, {seen}, country_code, line_type FROM phones",
        "d10_addresses": f"SELECT id address_id, {seen}, country_code, region_code, postal_code_prefix FROM addresses",
        "d11_identity_documents": f"SELECT id document_id, {seen}, document_type, issuing_country FROM documents",
        "d12_party_owns_account": edge("party_owns_account", "party_id", "account_id"),
        "d13_account_has_card": edge("account_has_card", "account_id", "card_id"),
        "d14_party_has_email": edge("party_has_email", "party_id", "email_id"),
        "d15_party_has_phone": edge("party_has_phone", "party_id", "phone_id"),
        "d16_party_has_address": edge("party_has_address", "party_id", "address_id"),
        "d17_party_has_identity_document": edge("party_has_identity_document", "party_id", "document_id"),
        "d18_party_has_device": edge("party_has_device", "party_id", "device_id"),
        "d19_party_has_ip": edge("party_has_ip", "party_id", "ip_id"),
        "d20_party_operates_merchant": edge("party_operates_merchant", "party_id", "merchant_id"),
        "d21_merchant_has_location": edge("merchant_has_location", "merchant_id", "location_id"),
        "d22_transactions": f"SELECT {cl('transaction_id')}, strftime(to_timestamp(unix_time) AT TIME ZONE 'UTC','%Y-%m-%d %H:%M:%S') event_time, {ms('unix_time')} event_ts_ms, event_seq, amount, {bo('amount_present')}, {cl('currency', 'transaction_type', 'channel', 'entry_mode')}, {bo('card_present', 'is_cross_border', 'is_recurring')}, {cl('merchant_category_code')}, {bo('has_event_location')}, event_latitude, event_longitude, device_risk_score, ip_risk_score, fraud_label, {bo('label_known')}, label_available_seq, {ms('label_available_unix_time')} label_available_ts_ms, {cl('label_source', 'account_id', 'card_id', 'merchant_id', 'location_id')} FROM manifest",
        "d23_transaction_used_device": f"SELECT transaction_id, device_id, {ms('unix_time')} event_ts_ms, event_seq FROM used_device",
        "d24_transaction_from_ip": f"SELECT transaction_id, ip_id, {ms('unix_time')} event_ts_ms, event_seq FROM from_ip",
    }
    return out


def compose(query: str, parts: dict[str, str]) -> str:
    """The query with the definitions it needs, each before its first use."""
    order: list[str] = []

    def need(sql: str, own: str = "") -> None:
        for w in dict.fromkeys(re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", sql)):
            if w in parts and w != own and w not in order:
                need(parts[w], w)
                order.append(w)

    need(query)
    return ("WITH " + ",\n".join(f"{w} AS MATERIALIZED ({parts[w]})" for w in order) + "\n" if order else "") + query
