"""DuckDB SQL for every key of ``__spark_entry__.queries()`` but the ``op`` ones.

Written from the mapping and the result tables of FIXTURES.md, not from the
Spark jobs: the driver's tables are folded into one row per order (``visit``),
denied visits meet their dimensions and rates once (``loss``), and each key
takes its figures straight from these two. Types are pinned with casts so both
engines return the same column types.

Rounded quotients are computed in whole numbers, because DuckDB divides
decimals in DOUBLE: ``round(p / q, s)`` is ``(2 p 10^s + q) div (2 q)`` units.
"""

from __future__ import annotations

# --- the driver's tables, folded ---------------------------------------------

#: One row per order: amounts, dates, and what its lines lead to. An order
#: without lines has no visit (``seen`` is false).
VISIT = """
visit as (
    select
        o.o_orderkey as k, o.o_custkey as cust, o.o_orderstatus as letter, o.o_orderpriority as urgency,
        cast(o.o_orderdate as date) as day,
        cast(o.o_totalprice as decimal(12,2)) as billed,
        cast(cast(o.o_totalprice as decimal(12,2)) * 0.55 as decimal(12,2)) as allowed,
        f.supp, p.p_partkey as part, p.p_name as part_name, p.p_type as part_type, p.p_size as part_size, p.p_brand as brand,
        p.p_partkey is not null as seen,
        p.p_partkey is not null and o.o_orderstatus = 'F' as lost
    from orders o
    left join (
        select l_orderkey as k, min(l_suppkey) as supp, min(l_partkey) as part from lineitem group by all
    ) f on f.k = o.o_orderkey
    left join part p on p.p_partkey = f.part
)"""

#: Fixed values, by the remainder of the brand number: category, win rate,
#: multiplier, worth appealing, fix probability, workflow action.
RATE = """
rate (remainder, category, win, mult, worth, fix, action) as (
    values
        (0, 'technical', 0.72::decimal(3,2), 1.00::decimal(3,2), true, 0.85::decimal(3,2),
         'Automate prior-auth / eligibility verification & documentation capture at intake'),
        (1, 'coding', 0.68::decimal(3,2), 0.95::decimal(3,2), true, 0.80::decimal(3,2),
         'Add pre-submission coding QA with dx-to-procedure edit checks'),
        (2, 'coverage', 0.30::decimal(3,2), 0.50::decimal(3,2), false, 0.35::decimal(3,2),
         'Verify benefits & coordination-of-benefits up front; appeal upside is limited'),
        (3, 'medical_necessity', 0.18::decimal(3,2), 0.35::decimal(3,2), false, 0.25::decimal(3,2),
         'Strengthen clinical documentation and align orders to payer medical-necessity policy')
)"""

#: Supplier with its nation and region; a supplier without either is none.
DOCTOR = """
doctor as (
    select s_suppkey as supp, s_name as name, n_name as specialty, r_name as region
    from supplier, nation, region
    where s_nationkey = n_nationkey and n_regionkey = r_regionkey
)"""

#: One row per denied visit whose provider, payer and reason are known, with the
#: dollars an appeal is expected to bring back.
LOSS = """
loss as (
    select v.*, doctor.name as doctor_name, doctor.specialty, doctor.region,
           customer.c_name as payer_name, customer.c_mktsegment as segment,
           rate.category, rate.win, rate.mult, rate.worth, rate.fix, rate.action,
           cast(round(v.billed * rate.win * rate.mult, 2) as decimal(18,2)) as back
    from visit v
    join doctor on doctor.supp = v.supp
    join customer on customer.c_custkey = v.cust
    join rate on rate.remainder = cast(split_part(v.brand, '#', 2) as integer) % 4
    where v.lost
)"""

_PARTS = {"visit": VISIT, "rate": RATE, "doctor": DOCTOR, "loss": LOSS}


def _with(body: str) -> str:
    """``body`` with those of the folded tables that it names."""
    need = {n for n in _PARTS if n in body}
    if "loss" in need:
        need = set(_PARTS)
    listed = [_PARTS[n].strip() for n in ("visit", "rate", "doctor", "loss") if n in need]
    return ("with " + ",\n".join(listed) + "\n" if listed else "") + body.strip() + "\n"


# --- small pieces --------------------------------------------------------------


def ratio(p: str, q: str, digits: int, out: str, times: int = 1) -> str:
    """round(times * p / q, digits) of whole numbers p and q >= 0, exact."""
    unit = "1" if not digits else f"0.{'0' * (digits - 1)}1"
    p, q = f"cast({p} as hugeint)", f"cast({q} as hugeint)"
    return f"cast(cast(({2 * times * 10**digits} * {p} + {q}) // nullif(2 * {q}, 0) as decimal(38,0)) * {unit} as {out})"


def cents(x: str) -> str:
    return f"(({x}) * 100)"


def key_of(*columns: str) -> str:
    # Fixed value: the text that stands for NULL in a key.
    texts = [f"coalesce(({c})::varchar, '_dbt_utils_surrogate_key_null_')" for c in columns]
    return f"md5(concat_ws('-', {', '.join(texts)}))"


STATUS = "case letter when 'F' then 'denied' when 'O' then 'paid' when 'P' then 'pending' end"
PAID = "case when letter = 'O' then allowed else cast(0 as decimal(12,2)) end"
REPLY = "case urgency when '1-URGENT' then 'appeal_won' when '2-HIGH' then 'appeal_lost' when '3-MEDIUM' then 'appeal_pending' else 'not_appealed' end"
DENIED_ON = "cast(day + cast(7 + k % 28 as integer) as date)"
CATEGORY = "case cast(split_part(p_brand, '#', 2) as integer) % 4 when 0 then 'technical' when 1 then 'coding' when 2 then 'coverage' else 'medical_necessity' end"
BIRTH = "date '1930-01-01' + cast(c_custkey % 30000 as integer)"

PROCEDURE = "part::varchar as procedure_code, part_name as procedure_desc, part_type as procedure_category, part_size::varchar as diagnosis_code"
MEASURES = """
    count(*)::bigint as denial_count,
    cast(sum(billed) as decimal(38,2)) as total_denied_billed,
    cast(sum(back) as decimal(38,2)) as total_recoverable"""

# --- result tables: select texts over visit, loss and the driver's tables --------

SEGMENTS = f"""
select customer.c_mktsegment as payer_type, doctor.specialty,
       count(*)::bigint as total_claims, (count(*) filter (where {STATUS} = 'denied'))::bigint as denied_claims
from visit join customer on c_custkey = cust join doctor on doctor.supp = visit.supp
where seen
group by all"""

BODY: dict[str, str] = {
    "stg_patients": f"""
select 'PT' || c_custkey as patient_id, c_name as first_name, c_name as last_name, cast({BIRTH} as date) as date_of_birth,
       if(c_custkey % 2 = 0, 'M', 'F') as gender, lpad(c_custkey::varchar, 5, '0') as zip_code,
       if(c_custkey % 10 = 0, 'BUILDING', c_mktsegment) as insurance_type
from customer""",
    "stg_encounters": f"""
select 'ENC' || k as encounter_id, 'PT' || cust as patient_id, 'PRV' || supp as provider_id, day as encounter_date, {PROCEDURE}
from visit where seen""",
    "stg_claims": f"""
select 'CLM' || k as claim_id, 'ENC' || k as encounter_id, 'PAY' || cust as payer_id, billed as billed_amount,
       allowed as allowed_amount, {PAID} as paid_amount, {STATUS} as claim_status, day as claim_date
from visit""",
    "stg_denials": f"""
select 'DNL' || k as denial_id, 'CLM' || k as claim_id, brand as carc_code, 'N' || (k % 10) as rarc_code,
       {DENIED_ON} as denial_date, {REPLY} as appeal_status
from visit where lost""",
    "stg_reason_codes": f"""
select distinct p_brand as carc_code, 'Reason ' || p_brand as carc_description, {CATEGORY} as carc_category from part""",
    "stg_providers": """
select 'PRV' || supp as provider_id, name as provider_name, specialty, lpad(supp::varchar, 10, '0') as npi, region from doctor""",
    "stg_payers": """
select 'PAY' || c_custkey as payer_id, c_name as payer_name, c_mktsegment as payer_type from customer""",
    "claims_with_denials": f"""
select 'CLM' || k as claim_id, 'ENC' || k as encounter_id, 'PAY' || cust as payer_id, billed as billed_amount,
       allowed as allowed_amount, {PAID} as paid_amount, {STATUS} as claim_status, day as claim_date,
       'PT' || cust as patient_id, 'PRV' || supp as provider_id, {PROCEDURE}, day as encounter_date,
       case when lost then 'DNL' || k end as denial_id, case when lost then brand end as carc_code,
       case when lost then 'N' || (k % 10) end as rarc_code, case when lost then {DENIED_ON} end as denial_date,
       case when lost then {REPLY} end as appeal_status, lost as is_denied
from visit where seen""",
    "reason_economics": f"""
select carc_code, 'Reason ' || carc_code as carc_description, category as carc_category, coalesce(worth, false) as is_high_appeal_value,
       win as appeal_win_rate, mult as category_multiplier
from (select distinct p_brand as carc_code, {CATEGORY} as own from part) left join rate on category = own""",
    "denial_fact": f"""
select {key_of("'DNL' || k")} as denial_key, 'DNL' || k as denial_id, 'CLM' || k as claim_id, 'ENC' || k as encounter_id,
       'PRV' || supp as provider_id, doctor_name as provider_name, specialty, region,
       'PAY' || cust as payer_id, payer_name, segment as payer_type, {PROCEDURE},
       brand as carc_code, 'Reason ' || brand as carc_description, category as carc_category, worth as is_high_appeal_value,
       billed as billed_amount, allowed as allowed_amount, {PAID} as paid_amount, win as appeal_win_rate, mult as category_multiplier,
       back as recoverable_amount, day as claim_date, {DENIED_ON} as denial_date, 'N' || (k % 10) as rarc_code, {REPLY} as appeal_status
from loss""",
    "segment_claims": SEGMENTS,
    "denial_patterns": f"""
select {key_of('payer_type', 'specialty', 'category')} as pattern_key, payer_type, specialty, category as carc_category, denial_count,
       codes as distinct_carc_codes, total_claims, denied_claims,
       {ratio('denied_claims', 'total_claims', 1, 'decimal(5,1)', 100)} as segment_denial_rate_pct, total_denied_billed, total_recoverable,
       {ratio(cents('total_recoverable'), '100 * denial_count', 2, 'decimal(38,2)')} as recoverable_per_denial
from (select segment as payer_type, specialty, category, count(distinct brand)::bigint as codes, {MEASURES} from loss group by all)
join ({SEGMENTS}) using (payer_type, specialty)""",
    "recoverable_pool": f"""
select category as carc_category, worth as is_high_appeal_value, denial_count, win as appeal_win_rate, mult as category_multiplier,
       total_denied_billed, total_recoverable,
       {ratio(cents('total_recoverable'), cents('(select sum(back) from loss)'), 1, 'decimal(18,1)', 100)} as pct_of_total_recoverable
from (select category, worth, min(win) as win, min(mult) as mult, {MEASURES} from loss group by category, worth)
order by total_recoverable desc nulls last""",
    "opportunities": f"""
select segment as payer_type, specialty, brand as carc_code, 'Reason ' || brand as carc_description, category as carc_category, {MEASURES}
from loss group by all""",
    "fix_recommendations": f"""
select row_number() over (order by total_recoverable * fix desc nulls last, segment, specialty, brand)::integer as priority_rank,
       segment as payer_type, specialty, brand as carc_code, 'Reason ' || brand as carc_description, category as carc_category,
       denial_count, total_denied_billed, total_recoverable, fix as fix_probability,
       cast(round(total_recoverable * fix, 2) as decimal(38,2)) as priority_score, action as recommended_action
from (select segment, specialty, brand, category, fix, action, {MEASURES} from loss group by all)
order by total_recoverable * fix desc nulls last, segment, specialty, brand
limit 5""",
    "mart_rollup": f"""
select payer_type, specialty, carc_code, carc_description, carc_category, is_high_appeal_value,
       case grouping(payer_type) * 8 + grouping(carc_code) * 4 + grouping(carc_category) * 2 + grouping(is_high_appeal_value)
            when 5 then 'pattern' when 12 then 'category' when 14 then 'flag' when 1 then 'opportunity' else 'total' end as level,
       count(distinct carc_code)::bigint as distinct_carc_codes, min(win) as appeal_win_rate, min(mult) as category_multiplier, {MEASURES}
from (select *, segment as payer_type, brand as carc_code, 'Reason ' || brand as carc_description, category as carc_category,
             worth as is_high_appeal_value from loss)
group by grouping sets (
    (payer_type, specialty, carc_category), (carc_category, is_high_appeal_value), (is_high_appeal_value),
    (payer_type, specialty, carc_code, carc_description, carc_category), ())""",
}

# --- checks --------------------------------------------------------------------

#: Checked columns (name of the row's key first), as in FIXTURES.md.
KEYS = {
    "stg_patients": "patient_id", "stg_providers": "provider_id", "stg_payers": "payer_id", "stg_reason_codes": "carc_code",
    "stg_encounters": "encounter_id", "stg_claims": "claim_id", "stg_denials": "denial_id", "claims_with_denials": "claim_id",
    "denial_fact": "denial_id", "denial_patterns": "pattern_key", "recoverable_pool": "carc_category", "fix_recommendations": "priority_rank",
}
FILLED = """
stg_patients patient_id; stg_providers provider_id; stg_payers payer_id; stg_reason_codes carc_code; stg_encounters encounter_id;
stg_claims claim_id encounter_id; stg_denials denial_id claim_id carc_code;
denial_fact denial_key denial_id claim_id carc_code billed_amount recoverable_amount; denial_patterns pattern_key total_recoverable;
recoverable_pool carc_category total_recoverable; fix_recommendations priority_rank recommended_action priority_score"""
SINGLE = """
stg_patients patient_id; stg_providers provider_id; stg_payers payer_id; stg_reason_codes carc_code; stg_encounters encounter_id;
stg_claims claim_id encounter_id; stg_denials denial_id claim_id; denial_fact denial_key denial_id claim_id;
denial_patterns pattern_key; recoverable_pool carc_category; fix_recommendations priority_rank"""
REFERS = """
stg_encounters patient_id stg_patients; stg_encounters provider_id stg_providers; stg_claims encounter_id stg_encounters;
stg_claims payer_id stg_payers; stg_denials claim_id stg_claims; stg_denials carc_code stg_reason_codes"""
_KINDS = "['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']"
_CAUSES = "['technical', 'coding', 'coverage', 'medical_necessity']"
ALLOWED = [
    ("stg_patients", "insurance_type", _KINDS),
    ("stg_patients", "gender", "['M', 'F']"),
    ("stg_providers", "specialty", "list_transform(range(25), lambda i: 'NATION_' || i)"),
    ("stg_payers", "payer_type", _KINDS),
    ("stg_reason_codes", "carc_category", _CAUSES),
    ("stg_claims", "claim_status", "['paid', 'denied', 'pending']"),
    ("stg_denials", "appeal_status", "['not_appealed', 'appeal_pending', 'appeal_won', 'appeal_lost']"),
    ("denial_fact", "carc_category", _CAUSES),
]
RULES = [
    (
        "recoverable_rule", "denial_fact", "recoverable_amount",
        "recoverable_amount is not distinct from cast(round(billed_amount * appeal_win_rate * category_multiplier, 2) as decimal(18,2))",
    ),
    ("paid_amount_rule", "stg_claims", "paid_amount", "paid_amount = if(claim_status = 'paid', allowed_amount, 0)"),
    ("claim_date_is_encounter_date", "claims_with_denials", "claim_date", "claim_date = encounter_date"),
]


def _listed(text: str) -> list[tuple[str, str]]:
    rows = [r.split() for r in text.split(";")]
    return [(r[0], c) for r in rows for c in r[1:]]


_REFERENCES = [tuple(r.split()) for r in REFERS.split(";")]

# each check of single rows: name, table, column, condition of failing rows, what is counted
_ROW_CHECKS = (
    [("not_null", t, c, f"{c} is null", "*") for t, c in _listed(FILLED)]
    + [("accepted_values", t, c, f"{c} is not null and not list_contains({v}, {c})", f"distinct {c}") for t, c, v in ALLOWED]
    + [(n, t, c, f"not coalesce({good}, false)", "*") for n, t, c, good in RULES]
)


def _entry(check: str, table: str, column: str, count: str) -> str:
    return f"select '{check}' as check_name, '{table}' as table_name, '{column}' as column_name, ({count})::bigint as failures"


def _row_check_sql(kinds: tuple[str, ...]) -> str:
    picked = [x for x in _ROW_CHECKS if x[0] in kinds]
    return " union all ".join(_entry(n, t, c, f"select count({what}) from ({BODY[t]}) where {bad}") for n, t, c, bad, what in picked)


def _repeats(table: str, column: str) -> str:
    return f"select {column} as v, count(*) as n from ({BODY[table]}) where {column} is not null group by 1 having count(*) > 1"


def _strays(child: str, column: str, parent: str) -> str:
    return f"select * from ({BODY[child]}) c where {column} is not null and not exists (select 1 from ({BODY[parent]}) p where p.{column} = c.{column})"


def _failing() -> str:
    def row(check: str, table: str, column: str, key: str, value: str, source: str) -> str:
        return (
            f"select '{check}' as check_name, '{table}' as table_name, '{column}' as column_name, "
            f"({key})::varchar as row_key, ({value})::varchar as value from ({source})"
        )

    rows = [row(n, t, c, KEYS[t], c, f"select * from ({BODY[t]}) where {bad}") for n, t, c, bad, _ in _ROW_CHECKS]
    rows += [row("unique", t, c, "v", "n || ' rows'", _repeats(t, c)) for t, c in _listed(SINGLE)]
    rows += [row("relationships", t, c, KEYS[t], c, _strays(t, c, p)) for t, c, p in _REFERENCES]
    return " union all ".join(rows)


def _grain() -> str:
    grain, fact, denials = (BODY[n] for n in ("claims_with_denials", "denial_fact", "stg_denials"))
    lacking = lambda a, b: f"select count(*) from ({a}) x where not exists (select 1 from ({b}) y where y.denial_id = x.denial_id)"
    return " union all ".join(
        [
            _entry("claims_preserved", "claims_with_denials", "claim_id", f"select (select count(*) from orders) - count(distinct claim_id) from ({grain})"),
            _entry("one_row_per_claim", "claims_with_denials", "claim_id", f"select count(*) - count(distinct claim_id) from ({grain})"),
            _entry("one_fact_row_per_denial", "denial_fact", "denial_id", lacking(denials, fact)),
            _entry("fact_denial_known", "denial_fact", "denial_id", lacking(fact, denials)),
            _entry("fact_denial_once", "denial_fact", "denial_id", f"select count(*) from (select denial_id from ({fact}) group by 1 having count(*) > 1)"),
            _entry(
                "denial_flag_matches_status", "claims_with_denials", "is_denied",
                f"select count(*) from ({grain}) where is_denied <> coalesce(claim_status = 'denied', false)",
            ),
        ]
    )


def _casts() -> str:
    """Rows whose raw text or number does not become a date or an amount."""
    lost_date = "{0} is not null and try_cast({0} as date) is null"
    lost_money = "{0} is not null and try_cast({0} as decimal(12,2)) is null"
    date = lambda x: lost_date.format(f"cast({x} as varchar)")
    money = [lost_money.format(f"cast({x} as double)") for x in ("billed", "allowed", PAID)]
    parts = []
    for table, source, faults in (
        ("stg_patients", "customer", [date(f"cast({BIRTH} as date)")]),
        ("stg_encounters", "visit where seen", [date("day")]),
        ("stg_claims", "visit", [*money, date("day")]),
        ("stg_denials", "visit where lost", [date(DENIED_ON)]),
        ("stg_reason_codes", "(select distinct p_brand from part)", []),
        ("stg_providers", "doctor", []),
        ("stg_payers", "customer", []),
    ):
        n = " + ".join([f"({f})::integer" for f in faults]) or "0"
        parts.append(
            f"select '{table}' as table_name, (count(*) filter (where {n} = 0))::bigint as good_rows, "
            f"(count(*) filter (where {n} > 0))::bigint as rejected_rows, coalesce(sum({n}), 0)::bigint as rejected_values from {source}"
        )
    return " union all ".join(parts)


CHECKS: dict[str, str] = {
    "check_not_null": _row_check_sql(("not_null",)),
    "check_accepted_values": _row_check_sql(("accepted_values",)),
    "check_row_rules": _row_check_sql(tuple(r[0] for r in RULES)),
    "checks_in_write": _row_check_sql(("not_null", "accepted_values", *(r[0] for r in RULES))),
    "check_unique": " union all ".join(_entry("unique", t, c, f"select count(*) from ({_repeats(t, c)})") for t, c in _listed(SINGLE)),
    "check_relationships": " union all ".join(_entry("relationships", t, c, f"select count(*) from ({_strays(t, c, p)})") for t, c, p in _REFERENCES),
    "check_grain": _grain(),
    "failing_rows": _failing(),
    "quarantine_report": _casts(),
    "orphan_claims": "select (count(*) filter (where not seen))::bigint as orphan_claims from visit",
}

# --- profile ---------------------------------------------------------------------

PROFILE: dict[str, str] = {
    "load_report": """
select 'raw_patients' as table_name, count(*)::bigint as row_count from customer
union all select 'raw_encounters', count(*) filter (where seen) from visit
union all select 'raw_claims', count(*) from orders
union all select 'raw_denials', count(*) filter (where lost) from visit
union all select 'dim_carc_codes', count(distinct p_brand) from part
union all select 'dim_providers', count(*) from doctor
union all select 'dim_payers', count(*) from customer""",
    "surrogate_key": f"""
select 'CLM' || k as claim_id, {key_of("'CLM' || k")} as claim_key,
       {key_of("'CLM' || k", "case when lost then 'DNL' || k end")} as claim_denial_key,
       {key_of("'PAY' || cust", 'day', 'billed')} as claim_attribute_key
from visit where seen""",
    "status_mix": f"""
select {STATUS} as claim_status, count(*)::bigint as claim_count,
       {ratio('count(*)', '(select count(*) from orders)', 3, 'decimal(4,3)')} as claim_share
from visit group by 1""",
    "denial_share": f"""
select (count(*) filter (where lost))::bigint as denial_rows, count(*)::bigint as claim_rows,
       {ratio('count(*) filter (where lost)', 'count(*)', 3, 'decimal(4,3)')} as denial_share
from visit""",
    "segment_lift": f"""
select payer_type, specialty, total_claims, denied_claims,
       {ratio('denied_claims', 'total_claims', 1, 'decimal(5,1)', 100)} as segment_denial_rate_pct,
       {ratio('every_denied', 'every_claim', 1, 'decimal(5,1)', 100)} as overall_denial_rate_pct, lift, coalesce(lift >= 1.20, false) as is_elevated
from (
    select *, {ratio('cast(denied_claims as hugeint) * every_claim', 'cast(total_claims as hugeint) * every_denied', 2, 'decimal(10,2)')} as lift
    from ({SEGMENTS}), (select sum(total_claims) as every_claim, sum(denied_claims) as every_denied from ({SEGMENTS})))""",
    "dominant_reason": f"""
select segment as payer_type, specialty, arg_min(brand, (-n, brand)) as carc_code, arg_min(category, (-n, brand)) as carc_category,
       max(n)::bigint as denial_count, sum(n)::bigint as segment_denials, {ratio('max(n)', 'sum(n)', 1, 'decimal(5,1)', 100)} as share_of_segment_pct
from (select segment, specialty, brand, category, count(*) as n from loss group by all)
group by segment, specialty""",
    "appealable_share": f"""
select worth as is_high_appeal_value, count(*)::bigint as denial_count, cast(sum(back) as decimal(38,2)) as total_recoverable,
       {ratio(cents('sum(back)'), cents('(select sum(back) from loss)'), 1, 'decimal(18,1)', 100)} as pct_of_total_recoverable
from loss group by worth""",
    "volume_by_weekday": """
select (isodow(day) - 1)::integer as weekday, count(*)::bigint as claim_count, (count(*) filter (where letter = 'F'))::bigint as denied_claims
from visit group by 1""",
    "volume_by_month": """
select cast(date_trunc('month', day) as date) as claim_month, count(*)::bigint as claim_count,
       (count(*) filter (where letter = 'F'))::bigint as denied_claims, cast(sum(billed) as decimal(38,2)) as total_billed
from visit group by 1""",
    "denial_lag": f"""
select count(*)::bigint as denials_joined, min(lag)::integer as min_lag_days, max(lag)::integer as max_lag_days,
       {ratio('sum(lag)', 'count(lag)', 2, 'decimal(10,2)')} as avg_lag_days, (count(*) filter (where lag < 7 or lag > 34))::bigint as out_of_range
from (select date_diff('day', day, {DENIED_ON}) as lag from visit where lost)""",
    "payer_match_rate": f"""
select count(*)::bigint as joined_claims, (count(*) filter (where agrees))::bigint as matched_claims,
       {ratio('count(*) filter (where agrees)', 'count(*)', 1, 'decimal(5,1)', 100)} as match_rate_pct
from (select c_mktsegment = if(c_custkey % 10 = 0, 'BUILDING', c_mktsegment) as agrees from visit join customer on c_custkey = cust where seen)""",
}

ORACLE_SQL: dict[str, str] = {k: _with(v) for k, v in (BODY | CHECKS | PROFILE).items()}
