"""DuckDB SQL for the registered queries, written from the description of the rules.

The derivations repeat ``plans.derive`` in SQL; the rules are written out anew
and share nothing with the Python ones.
"""

from __future__ import annotations

AS_OF = "timestamp '2026-01-01 00:00:00'"
BAD = "'Q#42' || chr(65533)"

POS = f"""
k as (
    select l.*, o.o_custkey, (l_orderkey*7919 + l_partkey*104729 + l_suppkey*1299709
        + l_linenumber*15485863) % 1000003 as h
    from lineitem l join orders o on l_orderkey = o_orderkey),
c as (
    select h, h // 100 % 100 as f, printf('TXN-%06d', l_orderkey) as txn,
        cast(l_linenumber as varchar) as seq,
        case when h % 10 >= 3 then printf('CUST-%05d', o_custkey) end as cust,
        strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000Z') as happened,
        cast(4006381000000 + l_partkey as varchar) as sku,
        cast(cast((100 + l_partkey*37 % 19800)/100 as decimal(10,2)) as varchar) as price,
        cast(cast(l_quantity as int) as varchar) as quantity,
        cast(cast(l_discount as decimal(10,2)) as varchar) as discount,
        cast(cast(l_tax as decimal(10,2)) as varchar) as tax,
        ['CREDIT_CARD','DEBIT_CARD','CASH','MOBILE_WALLET','GIFT_CARD'][h // 7 % 5 + 1] as payment,
        ['USD','CAD','GBP','EUR','EUR','AUD'][l_suppkey % 6 + 1] as currency,
        ['US','CA','GB','DE','FR','AU'][l_suppkey % 6 + 1] as country,
        ['IN_STORE','ONLINE','KIOSK','MOBILE_APP'][h % 4 + 1] as channel,
        printf('STORE-%03d', l_suppkey % 20 + 1) as store,
        printf('TERM-%02d', l_suppkey % 100) as terminal,
        l_shipdate + to_seconds(case when h // 10000 % 100 < 15 then 3601 + h % 5000
            else h % 3601 end) as ingested_time
    from k),
pos_raw as (
    select h as row_hash, f as fault,
        case when f = 14 then null else txn end as transaction_id,
        case f when 0 then null when 15 then '0' when 16 then 'x1' else seq end as item_sequence,
        case when f = 1 then {BAD} else cust end as customer_id,
        case f when 2 then '2025-19-39T77:00:00Z' when 3 then 'July 1st, half past two' when 4 then ''
            when 5 then '1970-01-01T00:00:00.000Z' when 17 then '2199-01-01T00:00:00.000Z'
            else happened end as event_time,
        case f when 6 then null when 18 then {BAD} else sku end as sku,
        case f when 7 then '-' || price when 8 then '1999700.01' when 19 then '200.00'
            when 20 then '200.01' else price end as item_unit_price,
        case f when 9 then '99999' when 10 then '-1' when 21 then '200' when 22 then '201'
            else quantity end as item_quantity,
        case f when 23 then '-0.01' when 24 then 'n/a' else discount end as discount_amount,
        case when f = 11 then '-1' else tax end as tax_amount,
        case f when 12 then 'BARTER' when 13 then '' else payment end as payment_type,
        currency, case when f = 25 then 'XX' else country end as country,
        case when f = 26 then 'FAX' else channel end as channel,
        case when f = 27 then 'STORE-021' else store end as store_id,
        case when f = 28 then 'TERM-1' else terminal end as terminal_id, ingested_time
    from c),
pos as (
    select *, try_cast(item_unit_price as decimal(10,2)) as price_,
        try_cast(item_quantity as decimal(10,2)) as quantity_,
        try_cast(event_time as timestamp) as time_, try_cast(item_sequence as int) as sequence_,
        try_cast(discount_amount as decimal(10,2)) as discount_,
        try_cast(tax_amount as decimal(10,2)) as tax_,
        cast(floor(epoch(ingested_time)) as bigint)
            - cast(floor(epoch(try_cast(event_time as timestamp))) as bigint) as delay
    from pos_raw)"""

_REQUIRED = (
    "transaction_id item_sequence event_time sku item_unit_price item_quantity discount_amount"
    " tax_amount payment_type currency country channel store_id terminal_id"
).split()
_STRICT = [*_REQUIRED[:2], "customer_id", *_REQUIRED[2:]]
_FORMATS = {
    "item_unit_price": "price_",
    "item_quantity": "quantity_",
    "event_time": "time_",
    "item_sequence": "sequence_",
    "discount_amount": "discount_",
    "tax_amount": "tax_",
}
_GARBLED = "(contains({0}, chr(65533)) or not {1})"
_BUSINESS = {
    "INVALID_RANGE_ITEM_SEQUENCE": "sequence_ <= 0",
    "INVALID_RANGE_ITEM_QUANTITY": "quantity_ <= 0 or quantity_ > 200",
    "INVALID_RANGE_ITEM_UNIT_PRICE": "price_ <= 0 or price_ > 200",
    "INVALID_RANGE_TAX_AMOUNT": "tax_ < 0",
    "INVALID_RANGE_DISCOUNT_AMOUNT": "discount_ < 0",
    "INVALID_FUTURE_EVENT_TIME": f"time_ > {AS_OF}",
    "EPOCH_RESET_TERMINAL_REBOOT": "time_ = timestamp '1970-01-01 00:00:00'",
    "GARBLED_CUSTOMER_ID": _GARBLED.format(
        "customer_id", "regexp_full_match(customer_id, 'CUST-[0-9]{5}')"
    ),
    "GARBLED_SKU": _GARBLED.format("sku", "regexp_full_match(sku, '[0-9]{13}')"),
    "GARBLED_STORE_ID": _GARBLED.format(
        "store_id", "store_id in (select printf('STORE-%03d', n) from range(1, 21) r(n))"
    ),
    "GARBLED_TERMINAL_ID": _GARBLED.format(
        "terminal_id", "regexp_full_match(terminal_id, 'TERM-[0-9]{2}')"
    ),
    "INVALID_ENUM_PAYMENT_TYPE": "payment_type not in"
    " ('CREDIT_CARD','DEBIT_CARD','CASH','MOBILE_WALLET','GIFT_CARD')",
    "INVALID_ENUM_CHANNEL": "channel not in ('IN_STORE','ONLINE','KIOSK','MOBILE_APP')",
    "INVALID_ENUM_COUNTRY": "country not in ('US','CA','GB','DE','FR','AU')",
}


def _list(rules: dict[str, str]) -> str:
    cases = ", ".join(f"case when {cond} then '{code}' end" for code, cond in rules.items())
    return f"list_filter([{cases}], lambda x: x is not null)"


_MISSING = {f"MISSING_{x.upper()}": f"{x} is null" for x in _REQUIRED}
_MISSING_STRICT = {f"MISSING_{x.upper()}": f"{x} is null" for x in _STRICT}
_FORMAT = {
    f"INVALID_FORMAT_{x.upper()}": f"{x} is not null and {y} is null" for x, y in _FORMATS.items()
}
FLAGGED = f"""{POS},
flagged as (
    select *, {_list({**_MISSING, **_FORMAT, **_BUSINESS})} as reasons,
        coalesce(delay > 3600, false) as is_late
    from pos)"""

_FIELDS = ", ".join(_STRICT)
_TYPED = """transaction_id, sequence_ as item_sequence, customer_id, time_ as event_time, sku,
    cast(price_ as double) as item_unit_price, cast(quantity_ as double) as item_quantity,
    cast(discount_ as double) as discount_amount, cast(tax_ as double) as tax_amount,
    payment_type, currency, country, channel, store_id, terminal_id, ingested_time"""
_LATE = f"{_TYPED}, is_late, delay as ingestion_delay_seconds"
_KEYED = "row_hash, transaction_id, item_sequence"


def _reasons(rules: dict[str, str]) -> str:
    return f"with {POS} select {_KEYED}, array_to_string({_list(rules)}, '|') as reasons from pos"


CUSTOMERS = """
k as (
    select o.*, c.c_name, n.n_name, n.n_regionkey,
        (o_orderkey*7919 + o_custkey*104729) % 1000003 // 100 % 100 as f
    from orders o join customer c on o_custkey = c_custkey join nation n on c_nationkey = n_nationkey),
cust_raw as (
    select f as fault, case when f = 0 then null else printf('CUST-%05d', o_custkey) end as customer_id,
        case f when 1 then null when 2 then '  ' else 'First' || o_custkey end as first_name,
        c_name as last_name,
        case when f = 3 then 'not-an-email' else 'c' || o_custkey || '@example.com' end as email,
        case when f = 4 then '5551234567'
            else printf('+1-555-%03d-%04d', o_custkey % 1000, o_orderkey % 10000) end as phone,
        case when f = 5 then 'Main St' else o_custkey || ' Main St' end as address,
        case when f = 6 then null else n_name end as city, 'S' || n_regionkey as state,
        'US' as country,
        case f when 7 then '13/45/1990' when 8 then '1850-01-01'
            else printf('%d-0%d-1%d', 1940 + o_custkey % 60, 1 + o_custkey % 9, o_custkey % 10) end
            as birth_date,
        case when f = 9 then 'X' when o_custkey % 2 = 0 then 'M' else 'F' end as gender,
        case when f = 10 then 'bad' else cast(o_orderdate as varchar) end as registration_date,
        case when f = 11 then 'Tin' when o_orderpriority like '1%' then 'Platinum'
            when o_orderpriority like '2%' then 'Gold' when o_orderpriority like '3%' then 'Silver'
            else 'Bronze' end as loyalty_tier,
        case when f = 12 then 'maybe' when o_orderstatus = 'F' then 'false' else 'true' end as is_active,
        case when f = 13 then '' else cast(o_orderdate as varchar) end as updated_at,
        case when f = 14 then '1234' else printf('%05d', o_custkey*7 % 100000) end as zip_code,
        o_orderdate as ingestion_time, o_orderkey as change_id
    from k)"""


def _matches(field: str, pattern: str) -> str:
    return f"{field} is not null and not regexp_full_match({field}, '{pattern}')"


def _misfit(field: str, kind: str) -> str:
    return f"{field} is not null and try_cast({field} as {kind}) is null"


_PHONE = (
    r"\+?\(?[0-9]{1,3}\)?[-. ]?\(?[0-9]{3}\)?[-. ]?[0-9]{3}[-. ]?[0-9]{4}"
    r"(\s?(x|ext\.?)\s?[0-9]{1,6})?"
)
_CUSTOMER_RULES = {
    "miss_customer_id": "customer_id is null",
    "miss_first_name": "first_name is null",
    "miss_last_name": "last_name is null",
    "miss_email": "email is null",
    "invalid_email": _matches("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    "miss_phone": "phone is null",
    "invalid_phone": _matches("phone", _PHONE),
    "miss_address": "address is null",
    "invalid_address": _matches("address", "[0-9]+[A-Za-z0-9 .,#-]*"),
    "miss_city": "city is null",
    "miss_state": "state is null",
    "miss_country": "country is null",
    "miss_birth_date": "birth_date is null",
    "birth_date_malformed": _misfit("birth_date", "date"),
    "miss_gender": "gender is null",
    "invalid_gender": "gender not in ('M','F')",
    "miss_registration_date": "registration_date is null",
    "registration_date_malformed": _misfit("registration_date", "timestamp"),
    "miss_loyalty_tier": "loyalty_tier is null",
    "invalid_loyalty_tier": "loyalty_tier not in ('Bronze','Silver','Gold','Platinum')",
    "miss_is_active": "is_active is null",
    "is_active_malformed": _misfit("is_active", "boolean"),
    "miss_updated_at": "updated_at is null",
    "updated_at_malformed": _misfit("updated_at", "timestamp"),
    "miss_zip_code": "zip_code is null",
    "invalid_zip_code": _matches("zip_code", "[0-9]{5}(-[0-9]{4})?"),
}
_PROFILE = """customer_id, first_name, last_name, email, phone, address, city, state, country,
    try_cast(birth_date as date) as birth_date, gender,
    try_cast(registration_date as timestamp) as registration_date, loyalty_tier,
    try_cast(is_active as boolean) as is_active, try_cast(updated_at as timestamp) as updated_at,
    zip_code"""
CUST_FLAGGED = f"""{CUSTOMERS},
flagged as (
    select change_id, ingestion_time as changed_at, {_PROFILE}, {AS_OF} as ingestion_time,
        {_list(_CUSTOMER_RULES)} as reasons
    from cust_raw)"""
_NAMES = """customer_id, first_name, last_name, email, phone, address, city, state, country,
    birth_date, gender, registration_date, loyalty_tier, is_active, updated_at, zip_code"""
_COMPLETE = (
    "first_name is not null and last_name is not null and trim(first_name) <> ''"
    " and trim(last_name) <> ''"
)
_AGED = f"(birth_date is null or birth_date between date '1900-01-01' and cast({AS_OF} as date))"
_GUARDED = f"""{CUST_FLAGGED},
cleaned as (
    select change_id, changed_at, {_NAMES} from flagged
    where len(reasons) = 0 and {_COMPLETE} and {_AGED})"""
_TIES = f"updated_at desc nulls last, {', '.join(f'{c.strip()} desc nulls last' for c in _NAMES.split(','))}"
_ONE = f"""{_GUARDED},
one as (
    select changed_at, {_NAMES} from cleaned
    qualify row_number() over (partition by customer_id, changed_at order by {_TIES}) = 1)"""

_ROUTED = f"""{FLAGGED},
routed as (
    select case when len(reasons) > 0 then 'quarantine' when is_late then 'late' else 'clean' end
        as route, * from flagged)"""


def _merge(keys: str) -> str:
    on = " and ".join(f"t.{k} = s.{k}" for k in keys.split(", "))
    return f"""
        with {FLAGGED},
        rows as (
            select {_LATE}, row_hash % 2 = 0 as old, row_number() over (
                partition by {keys}, row_hash % 2 order by row_hash, sku, store_id,
                    ingested_time) as rn,
                bool_or(row_hash % 2 = 0) over (partition by {keys}) as known
            from flagged where len(reasons) = 0),
        t as (select * from rows where old),
        s as (select * from rows where not old and (rn = 1 or not known))
        select transaction_id, item_sequence, sku, store_id, item_unit_price, ingested_time
        from t where not exists (select 1 from s where {on})
        union all
        select s.transaction_id, s.item_sequence, s.sku, s.store_id, s.item_unit_price,
            s.ingested_time
        from t join s on {on}
        union all
        select transaction_id, item_sequence, sku, store_id, item_unit_price, ingested_time
        from s where not exists (select 1 from t where {on})"""


_BRONZE = f"with {POS} select {_FIELDS}, ingested_time from pos_raw"
_ROUTES = f"""with {_ROUTED}
    select route, transaction_id, item_sequence, customer_id, ingested_time,
        array_to_string(reasons, '|') as reasons from routed"""
_SCD1 = f"""with {_ONE}
    select {_NAMES}, changed_at as ingestion_time from one
    qualify row_number() over (partition by customer_id order by changed_at desc) = 1"""
_SCD2 = f"""with {_ONE}
    select {_NAMES}, changed_at as ingestion_time, changed_at as valid_from,
        lead(changed_at) over (partition by customer_id order by changed_at) as valid_to from one"""

ORACLES = {
    "pos_decode": _BRONZE,
    "pos_cast": f"""with {POS} select {_KEYED}, cast(price_ as double) as unit_price,
        cast(quantity_ as double) as quantity, time_ as event_time, cast(sequence_ as double) as sequence,
        cast(discount_ as double) as discount, cast(tax_ as double) as tax from pos""",
    "pos_reasons_missing": _reasons(_MISSING),
    "pos_reasons_strict": _reasons(_MISSING_STRICT),
    "pos_reasons_format": _reasons(_FORMAT),
    "pos_reasons_business": _reasons(_BUSINESS),
    "pos_reasons": _reasons({**_MISSING, **_FORMAT, **_BUSINESS}),
    "pos_quarantine": f"""with {FLAGGED} select {_FIELDS}, ingested_time,
        array_to_string(reasons, '|') as error_reason, true as is_corrupted
        from flagged where len(reasons) > 0""",
    "pos_valid": f"with {FLAGGED} select {_LATE} from flagged where len(reasons) = 0",
    "pos_late": f"with {FLAGGED} select {_LATE} from flagged where len(reasons) = 0 and is_late",
    "pos_on_time": f"with {FLAGGED} select {_TYPED} from flagged where len(reasons) = 0 and not is_late",
    "pos_contract": f"with {FLAGGED} select {_TYPED} from flagged where len(reasons) = 0 and not is_late",
    "pos_route_counts": f"with {_ROUTED} select route, count(*) as n_rows from routed group by route",
    "pos_delay": f"""with {FLAGGED} select {_KEYED}, cast(delay as double) as ingestion_delay_seconds, is_late
        from flagged""",
    "pos_late_10min": f"""with {POS}, d as (select *, cast(epoch({AS_OF}) as bigint)
            - cast(floor(epoch(time_)) as bigint) as now_delay from pos)
        select {_KEYED}, cast(now_delay as double) as ingestion_delay_seconds,
            coalesce(now_delay > 600, false) as is_late from d""",
    "pos_merge": _merge("transaction_id"),
    "pos_merge_line_key": _merge("transaction_id, item_sequence"),
    "pos_preview": f"""with {FLAGGED} select {_KEYED}, sku, ingested_time from flagged
        order by transaction_id nulls last, item_sequence nulls last, sku nulls last,
            ingested_time nulls last, row_hash limit 20""",
    "cust_cast": f"with {CUST_FLAGGED} select change_id, {_NAMES}, ingestion_time from flagged",
    "cust_reasons": f"""with {CUST_FLAGGED} select change_id, {_NAMES}, ingestion_time,
        array_to_string(reasons, '|') as dq_failure_reasons from flagged""",
    "cust_dead_letters": f"""with {CUST_FLAGGED} select change_id, {_NAMES}, ingestion_time,
        array_to_string(reasons, '|') as dq_failure_reasons, true as is_corrupted
        from flagged where len(reasons) > 0""",
    "cust_cleaned": f"""with {CUST_FLAGGED} select {_NAMES}, ingestion_time from flagged
        where len(reasons) = 0""",
    "cust_expect_drop": f"""with {CUST_FLAGGED} select {_NAMES}, ingestion_time from flagged
        where len(reasons) = 0 and {_COMPLETE} and {_AGED}""",
    "cust_expect_counts": f"""with {CUST_FLAGGED}, kept as (
            select * from flagged where len(reasons) = 0)
        select 'valid_id' as expectation, count(*) filter (customer_id is null) as n_violations
        from kept union all
        select 'completed_profile', count(*) filter (not coalesce({_COMPLETE}, false)) from kept
        union all select 'realistic_age', count(*) filter (not coalesce({_AGED}, false)) from kept
        union all select 'no_upstream_failures', count(*) filter (len(reasons) > 0) from kept""",
    "cust_scd1": _SCD1,
    "cust_scd2": _SCD2,
    "cust_scd2_tracked": f"""with {_ONE},
        compared as (
            select *, lag(hash_) over w as before, row_number() over w as rn from (
                select *, loyalty_tier || '|' || is_active as hash_ from one) x
            window w as (partition by customer_id order by changed_at)),
        opened as (select * from compared where rn = 1 or before <> hash_)
        select {_NAMES}, changed_at as ingestion_time, changed_at as valid_from,
            lead(changed_at) over (partition by customer_id order by changed_at) as valid_to
        from opened""",
    "stream_bronze": _BRONZE,
    "stream_routes": _ROUTES,
    "stream_supervised": _ROUTES,
    "stream_named_table": _BRONZE,
    "pos_catalog": f"""with {FLAGGED}, clean as (
            select * from flagged where len(reasons) = 0 and not is_late)
        select transaction_id, sequence_ as item_sequence, sku, ingested_time,
            2 * count(*) over () as n_twice, 0 as n_emptied, false as dropped_exists from clean""",
    "stream_expectations": f"""with {CUST_FLAGGED},
        kept as (select *, change_id % 3 as batch from flagged where len(reasons) = 0),
        counted as (
            select batch, count(*) as n_judged,
                count(*) filter (customer_id is null) as valid_id,
                count(*) filter (not coalesce({_COMPLETE}, false)) as completed_profile,
                count(*) filter (not coalesce({_AGED}, false)) as realistic_age,
                count(*) filter (len(reasons) > 0) as no_upstream_failures
            from kept group by batch)
        unpivot counted on valid_id, completed_profile, realistic_age, no_upstream_failures
            into name expectation value n_violations""",
    "stream_customers": f"""with {_GUARDED},
        arrived as (
            select {_NAMES}, {AS_OF} + to_days(cast(change_id % 3 as int)) as moment from cleaned
            qualify row_number() over (
                partition by customer_id, change_id % 3 order by {_TIES}) = 1)
        select {_NAMES}, moment as ingestion_time, moment as valid_from,
            lead(moment) over (partition by customer_id order by moment) as valid_to from arrived""",
    "cust_files_by_name": f"""with {CUSTOMERS}
        select {", ".join(
            f"case when change_id % 3 < 2 then {n} end as {n}" if i > 3 else n
            for i, n in enumerate(_NAMES.replace(chr(10), " ").replace(" ", "").split(",")))},
            {AS_OF} as ingestion_time,
            case change_id % 3
                when 0 then case when fault < 50 then 'fault=' || fault || ';' else '' end
                    || 'note=no. ' || change_id || ', "new"'
                when 1 then '#17=see ' || change_id end as rescued,
            change_id % 3 < 2 as has_path
        from cust_raw""",
}

# Dates as text: a date and a midnight are not told apart by every reader.
ORACLES |= {
    name: f"select * replace (cast(birth_date as varchar) as birth_date) from ({sql}) x"
    for name, sql in ORACLES.items()
    if name.split("_")[-1] in "cast reasons letters cleaned drop scd1 scd2 tracked customers".split()
    and not name.startswith("pos_")
}
