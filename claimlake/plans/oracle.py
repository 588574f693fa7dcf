"""The registered queries again as ANSI SQL, written from the table definitions.

Nothing here is shared with the Spark side but the column lists of the schemas.
"""

from __future__ import annotations

from claimlake.schemas import CLAIMS_DDL, REMITTANCE_DDL

VIEWS = {
    "claims": """
with l as (select l_orderkey, l_linenumber, min(l_suppkey) s, min(l_partkey) p, min(l_shipdate) ship,
    sum(cast(l_extendedprice as decimal(12,2))) g,
    sum(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))) n
  from lineitem group by l_orderkey, l_linenumber)
select 'C' || l_orderkey as claimid, 'M' || o_custkey as memberid,
  case when l_orderkey % 101 = 0 then cast(0 as double) else cast(g as double) end as gross,
  cast(g - n as double) as patientshare, cast(n as double) as netclaim, cast(n as double) as activitynet,
  case when l_orderkey % 89 = 0 then '9' else substr(o_orderpriority, 1, 1) end as encountertype, o_orderdate as bill_finalized_date, ship as submission_date,
  case when l_orderkey % 50 = 0 then 'X' when o_orderstatus = 'F' then 'C' when o_orderstatus = 'O' then 'S' else 'N' end as claim_status,
  case when l_orderkey % 97 = 0 then '99' else cast(s % 25 as varchar(9)) end as center_id,
  l_orderkey || '.' || l_linenumber || case l_linenumber % 3 when 1 then '-I1' when 2 then '-R2' else '' end as activityid,
  case p % 7 when 0 then '99213' when 1 then ' 99285 ' when 2 then '9.01' when 3 then '61.08' when 4 then '99499' when 5 then '9922' else '80050' end as activitycode,
  cast(case when l_orderkey % 17 <> 0 then 1 + l_orderkey % 2 end as int) as org_sub_seq,
  case when s % 10 <> 0 then 'S' || s end as clinician,
  case when s % 7 = 0 then '' when s % 11 <> 0 then 'S' || (s + 1) end as orderingclinician,
  case l_linenumber when 1 then 'OPDOC' when 2 then 'ROPDOC' else 'LAB' end as charge_head,
  case when s % 3 <> 0 then 'S' || (s + 2) end as payee_doctor_id,
  case when s % 4 <> 0 then 'S' || (s + 3) end as prescribing_dr_id,
  'S' || (s + 4) as admitting_dr_id,
  strftime(o_orderdate, '%d/%m/%Y') as encounterstart, case when p % 30 = 0 then 'P-' else 'P' || p end as plan_id, case when o_custkey % 20 = 0 then 'I-' else 'I' || o_custkey end as insurance_co_id,
  'T' || (o_custkey % 4) as tpa_id, cast(o_custkey % 5 as int) as org_id,
  case when l_orderkey % 3 = 0 then 'E' || l_linenumber end as denial_code
from l join orders on l_orderkey = o_orderkey""",
    "remittance": """
select 'C' || l_orderkey as claim_id, l_orderkey || '.' || l_linenumber as activity_id,
  cast(row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag) as int) as ra_seq,
  l_shipdate as transaction_date,
  case when l_returnflag = 'R' and l_partkey % 11 = 0 then 'D-' when l_returnflag = 'R' then 'D' || l_suppkey end as denial_code,
  cast(case when l_returnflag = 'R' then 0 else cast(l_extendedprice as decimal(12,2)) * cast((10 - l_partkey % 3) as decimal(3,0)) end as double) / 10 as received_amount,
  case when l_partkey % 50 = 0 then cast(0 as double) else l_extendedprice end as insurance_claim_amt,
  cast(l_suppkey % 5 as int) as org_id, 'R' || l_partkey as reference_no
from lineitem where l_returnflag <> 'N'""",
    "open_claims": """
select 'C' || o_orderkey as claimid, case when o_orderkey % 10 = 0 then 'n/a' else strftime(o_orderdate, '%d/%m/%Y') || ' 10:00' end as start_date,
  cast(o_custkey % 25 as varchar(9)) as center_id, case when o_custkey % 30 = 0 then 'P-' else 'P' || o_custkey end as plan_id, case when o_custkey % 20 = 0 then 'I-' else 'I' || o_custkey end as insurance_co_id,
  case when o_custkey % 3 <> 0 then 'S' || (o_custkey // 15) end as payee_doctor_id,
  case when o_custkey % 4 <> 0 then 'S' || (o_custkey // 15 + 1) end as prescribing_dr_id,
  'S' || (o_custkey // 15 + 2) as admitting_dr_id, o_totalprice as gross
from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "hospitals": """
select ' ' || n_nationkey || ' ' as center_id, n_name as center_name, 'H' || n_nationkey as hospital_center_service_reg_no, 'HA' || n_regionkey as health_authority from nation""",
    "clusters": """
select 'K' || r_regionkey as cluster_id, r_name as cluster_name, case when n_nationkey % 6 = 5 then 'x' else '' end || n_nationkey || ' ' as center_id from nation join region on n_regionkey = r_regionkey""",
    "insurers": """
select 'I' || c_custkey as insurance_co_id, c_name as insurance_co_name from customer""",
    "plans": """
select 'P' || p_partkey as plan_id, case when p_partkey % 40 < 7 then 'G-' else 'G' || (p_partkey % 8) end as category_id, p_name as plan_name, 'RR' || p_size as rateplan_rule_id from part""",
    "categories": """
select 'G' || (p_partkey % 8) as category_id, min(p_type) as category_name from part group by 'G' || (p_partkey % 8)""",
    "organizations": """
select cast(r_regionkey as int) as org_id, r_name as org_name from region""",
    "encounter_types": """
select distinct substr(o_orderpriority, 1, 1) as id, substr(o_orderpriority, 3, 20) as encounter_type_desc from orders""",
    "tpa": """
select 'T' || r_regionkey as tpa_id, case when r_regionkey % 2 = 0 then 'XML' else 'XLS' end as claim_format from region""",
    "denial_codes": """
select 'D' || s_suppkey as denial_code, 'reason ' || s_suppkey as code_description, case s_suppkey % 3 when 0 then 'payer' when 1 then 'provider' end as responsibility from supplier""",
    "doctors": """
select 'S' || s_suppkey as doctor_id, s_name as doctor_name, 'spec' || (s_suppkey % 4) as specialization, case when s_suppkey % 24 = 0 then 'N-' else 'N' || s_nationkey end as dept_id from supplier""",
    "licences": """
select case when s_suppkey % 5 = 0 then 'S-' else 'S' end || s_suppkey as doctor_id, case when s_suppkey % 13 <> 0 then 'L' || s_suppkey end as doctor_license_number from supplier""",
    "departments": """
select 'N' || n_nationkey as dept_id, 'dept ' || n_name as dept_name from nation""",
    "referrals": """
select case when c_custkey % 9 <> 0 then 'L' || c_custkey end as clinician_id, c_name as name from customer""",
    # Derived steps that several queries share.
    "prep": """
select *, cast(try_strptime(encounterstart, '%d/%m/%Y') as date) as encounterstart_date,
  case when position('-I' in activityid) > 0 then substr(activityid, 1, position('-I' in activityid) - 1)
       when position('-R' in activityid) > 0 then substr(activityid, 1, position('-R' in activityid) - 1)
       else activityid end as cleaned_activityid,
  case when clinician is null then orderingclinician else clinician end as doc_id,
  case when orderingclinician is null or orderingclinician = '' then
         case when charge_head in ('OPDOC', 'ROPDOC') then payee_doctor_id
              when prescribing_dr_id is not null then prescribing_dr_id
              when payee_doctor_id is not null then payee_doctor_id else admitting_dr_id end
       else orderingclinician end as ordering_doc_id
from claims""",
    "opened": """
select *, cast(try_strptime(substr(start_date, 1, 10), '%d/%m/%Y') as date) as encounter_start_date,
  coalesce(prescribing_dr_id, payee_doctor_id, admitting_dr_id) as ordering_doc_id,
  coalesce(payee_doctor_id, prescribing_dr_id, admitting_dr_id) as doctor_id
from open_claims""",
    "hospital_dim": """
select h.center_id, h.center_name, h.hospital_center_service_reg_no, h.health_authority,
  h.center_name_key, k.cluster_id, k.cluster_name, upper(k.cluster_name) as cluster_sa
from (select trim(center_id) as center_id, center_name, hospital_center_service_reg_no, health_authority,
        upper(center_name) as center_name_key from hospitals where trim(center_id) <> '0') h
left join (select trim(center_id) as center_id, cluster_id, cluster_name from clusters) k on h.center_id = k.center_id""",
    "plan_dim": """
select p.category_id, p.plan_id, p.plan_name, p.rateplan_rule_id, n.category_name
from plans p left join categories n on p.category_id = n.category_id""",
    "doctor_dim": """
select d.dept_id, d.doctor_id, d.doctor_name, d.specialization, dp.dept_name
from doctors d left join departments dp on d.dept_id = dp.dept_id""",
    "licensed_dim": """
select d.dept_id, d.doctor_id, d.doctor_name, d.specialization, li.doctor_license_number, dp.dept_name
from doctors d join licences li on d.doctor_id = li.doctor_id left join departments dp on d.dept_id = dp.dept_id""",
    "denial_dim": """
select denial_code as latest_denial_code, code_description as denial_description, responsibility as denial_responsibility from denial_codes""",
    "encounter_dim": """
select id as encountertype, encounter_type_desc from encounter_types""",
    "latest_denial": """
select claim_id, activity_id, denial_code as latest_denial_code from (
  select *, row_number() over (partition by claim_id, activity_id order by ra_seq desc, transaction_date desc, denial_code) as rn
  from remittance where denial_code is not null) where rn = 1""",
    "received": """
select claim_id, activity_id, min(case when ra_seq = 2 then transaction_date end) as first_received,
  min(case when ra_seq = 3 then transaction_date end) as second_received,
  min(case when ra_seq = 4 then transaction_date end) as third_received
from remittance group by claim_id, activity_id""",
    "matched": """
select c.*, r.ra_seq, r.transaction_date, r.denial_code as ra_denial_code, r.received_amount, r.insurance_claim_amt,
  r.org_id as ra_org_id, r.reference_no
from prep c left join remittance r on c.claimid = r.claim_id and c.cleaned_activityid = r.activity_id""",
    "matched_inner": """
select c.*, r.ra_seq, r.transaction_date, r.denial_code as ra_denial_code, r.received_amount, r.insurance_claim_amt,
  r.org_id as ra_org_id, r.reference_no
from prep c join remittance r on c.claimid = r.claim_id and c.cleaned_activityid = r.activity_id""",
    "claim_totals": """
select claimid, cast(sum(cast(netclaim as decimal(18,4))) as double) as total_claim_amount from claims group by claimid""",
    "paid_totals": """
select claim_id, cast(sum(cast(received_amount as decimal(18,4))) as double) as total_paid_amount,
  count(denial_code) as denial_count from remittance group by claim_id""",
    "scored": """
select c.*, t.total_claim_amount, p.total_paid_amount, p.total_paid_amount as total_approved_amount, p.denial_count,
  case when t.total_claim_amount > 0 then (t.total_claim_amount - p.total_paid_amount) / t.total_claim_amount else 0 end as rejection_rate,
  case when t.total_claim_amount > 0 then p.total_paid_amount / t.total_claim_amount else 0 end as payment_ratio,
  cast(datediff('day', encounterstart_date, cast(submission_date as date)) as int) as processing_days
from prep c left join claim_totals t on c.claimid = t.claimid left join paid_totals p on c.claimid = p.claim_id""",
    "placed": """
select d.doctor_id, d.doctor_name, li.doctor_license_number, dp.dept_name
from doctors d join licences li on d.doctor_id = li.doctor_id join departments dp on d.dept_id = dp.dept_id""",
    "unlicensed": """
select clinician_id, name from referrals where clinician_id not in (
  select doctor_license_number from licences where doctor_license_number is not null)""",
    "names": """
select doctor_license_number, dept_name, max(doctor_name) as doctor_name from placed group by doctor_license_number, dept_name
union all
select clinician_id, '', max(name) from unlicensed group by clinician_id""",
    "doctor_union": """
select doctor_license_number, dept_name, doctor_name from names
union
select doctor_id, dept_name, doctor_name from placed""",
}

# Which views a view reads, in the order of the list above.
USES = {
    "prep": ["claims"], "opened": ["open_claims"],
    "hospital_dim": ["hospitals", "clusters"], "plan_dim": ["plans", "categories"],
    "doctor_dim": ["doctors", "departments"],
    "licensed_dim": ["doctors", "licences", "departments"],
    "denial_dim": ["denial_codes"], "encounter_dim": ["encounter_types"],
    "latest_denial": ["remittance"], "received": ["remittance"],
    "matched": ["claims", "prep", "remittance"],
    "matched_inner": ["claims", "prep", "remittance"],
    "claim_totals": ["claims"], "paid_totals": ["remittance"],
    "scored": ["claims", "remittance", "prep", "claim_totals", "paid_totals"],
    "placed": ["doctors", "licences", "departments"],
    "unlicensed": ["referrals", "licences"],
    "names": ["doctors", "licences", "departments", "referrals", "placed", "unlicensed"],
    "doctor_union": ["doctors", "licences", "departments", "referrals", "placed",
                     "unlicensed", "names"],
}


def over(views: str, select: str) -> str:
    """A query over the named views, with the views they read in front."""
    needed = set()
    for name in views.split():
        needed |= {name, *USES.get(name, [])}
    ctes = [f"{name} as ({VIEWS[name]})" for name in VIEWS if name in needed]
    return f"with {', '.join(ctes)}\n{select}"


def _conform(table: str, ddl: str, have: set[str], required: str) -> str:
    types = {"string": "varchar", "double": "double", "int": "integer",
             "timestamp_ntz": "timestamp"}
    items = []
    for item in ddl.replace("\n", " ").split(","):
        name, kind, *_ = item.split()
        value = name if name in have else "null"
        items.append(f"try_cast({value} as {types[kind]}) as {name}")
    return over(table, f"select {', '.join(items)}, {required} is null as schema_violation from {table}")


CLAIM_COLUMNS = set("""claimid memberid gross patientshare netclaim activitynet encountertype
bill_finalized_date submission_date claim_status center_id activityid activitycode org_sub_seq
clinician orderingclinician charge_head payee_doctor_id prescribing_dr_id admitting_dr_id
encounterstart plan_id insurance_co_id tpa_id org_id denial_code""".split())
REMITTANCE_COLUMNS = set("""claim_id activity_id ra_seq transaction_date denial_code
received_amount insurance_claim_amt org_id reference_no""".split())

EVALUATION = """('99201','99202','99203','99204','99205','99211','99212','99213','99214','99215',
'99281','99282','99283','99284','99285')"""
CONSULTATION = """('9','9.01','9.02','10','10.01','10.02','11','11.01','11.02','61.01','61.02',
'61.03','61.04','61.08')"""


def code_or_na(test: str) -> str:
    return f"case when {test} then trim(activitycode) else 'NA' end"


EM = code_or_na(f"trim(activitycode) in {EVALUATION}")
DXB = code_or_na(f"trim(activitycode) in {CONSULTATION}")
CONSULT = code_or_na("trim(activitycode) >= '99201' and trim(activitycode) <= '99499'")

STATUS_BASIC = """case when claim_status = 'N' then 'Pending Reconciliation'
  when claim_status = 'S' and org_sub_seq = 1 and coalesce(ra_seq, 0) = 0 then 'Submitted'
  when claim_status = 'S' and org_sub_seq = 1 and coalesce(ra_seq, 0) >= 1 then 'Denied'"""
STATUS_FULL = STATUS_BASIC + """
  when claim_status = 'S' and org_sub_seq > 1 then 'Resubmitted'
  when claim_status = 'C' then 'Closed' else 'Unknown' end"""
STATUS_BASIC += " else 'Unknown' end"

PAYMENT_STATUS = """case when total_paid_amount is null then 'Pending' when total_paid_amount = 0 then 'Denied'
  when total_paid_amount < total_claim_amount then 'Partially Paid' else 'Fully Paid' end"""

REIMBURSEMENT = "round(netclaim / nullif(gross, 0), 4)"
PATIENT_SHARE = "round(patientshare / nullif(gross, 0), 4)"
FINALIZE = "round((epoch_us(bill_finalized_date) - epoch_us(submission_date)) / 86400000000.0, 0)"
PAID_RATIO = "round(received_amount / nullif(insurance_claim_amt, 0), 4)"
FULL = f"coalesce({PAID_RATIO} >= 0.99, false)"
EFFICIENCY = "round(received_amount / nullif(netclaim, 0), 4)"
ELAPSED = "round((epoch_us(transaction_date) - epoch_us(bill_finalized_date)) / 86400000000.0, 0)"
CALENDAR = "cast(datediff('day', cast(bill_finalized_date as date), cast(transaction_date as date)) as double)"
WRITE_OFF = "cast(round(cast(netclaim as decimal(18,4)) - cast(received_amount as decimal(18,4)), 2) as double)"

ACT = "claimid, activityid"
PAY = "claim_id, activity_id, ra_seq"


def money(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,4))) as double)"


def cents(column: str) -> str:
    return f"coalesce(cast(round(sum(cast({column} as decimal(18,4))), 2) as double), 0)"


def settled(value: str, places: int = 4) -> str:
    """Rounded after the noise of a double sum is cut off."""
    return f"cast(round(cast({value} as decimal(28,8)), {places}) as double)"


def center_report(source: str) -> str:
    return f"""select m.center_id, h.center_name, count(claimid) as total_claims, {money('gross')} as total_gross,
  {money('netclaim')} as total_net, {money('received_amount')} as total_received, {money(WRITE_OFF)} as total_write_off,
  avg({CALENDAR}) as avg_days_to_payment, avg(case when {CALENDAR} > 30 then 1 else 0 end) as delayed_payment_rate,
  cast(sum(cast({REIMBURSEMENT} as decimal(18,4))) as double) / count({REIMBURSEMENT}) as avg_reimbursement_rate
from {source} m left join hospital_dim h on m.center_id = h.center_id group by m.center_id, h.center_name"""


DOCTOR_JOINS = """left join {dim} d on {treating} = d.doctor_id left join {dim} od on {ordering} = od.doctor_id"""
DOCTOR_LABELS = """d.doctor_name, d.dept_name as doctor_dept, od.doctor_name as ordering_doctor_name,
  od.dept_name as ordering_doctor_dept"""


def doctor_joins(dim: str, treating: str, ordering: str) -> str:
    return DOCTOR_JOINS.format(dim=dim, treating=treating, ordering=ordering)


ENRICH_CLAIMS = f"""left join hospital_dim h on c.center_id = h.center_id
left join insurers i on c.insurance_co_id = i.insurance_co_id left join plan_dim p on c.plan_id = p.plan_id
{doctor_joins('licensed_dim', 'c.doc_id', 'c.ordering_doc_id')} left join encounter_dim e on c.encountertype = e.encountertype"""
ENRICH_OPEN = f"""left join hospital_dim h on c.center_id = h.center_id
left join insurers i on c.insurance_co_id = i.insurance_co_id left join plan_dim p on c.plan_id = p.plan_id
{doctor_joins('licensed_dim', 'c.doctor_id', 'c.ordering_doc_id')}"""
ENRICHED = f"""h.center_name, h.cluster_name, i.insurance_co_name, p.plan_name, p.category_name,
  {DOCTOR_LABELS}"""
DIMS = "hospital_dim insurers plan_dim licensed_dim encounter_dim"

CLAIMS_LABELS = f"""h.center_name, h.cluster_name, p.plan_name, p.category_name, {DOCTOR_LABELS},
  e.encounter_type_desc, ld.latest_denial_code, dc.denial_description, dc.denial_responsibility
from prep c left join hospital_dim h on c.center_id = h.center_id left join plan_dim p on c.plan_id = p.plan_id
{doctor_joins('doctor_dim', 'c.doc_id', 'c.ordering_doc_id')}
left join encounter_dim e on c.encountertype = e.encountertype
left join latest_denial ld on c.claimid = ld.claim_id and c.activityid = ld.activity_id
left join denial_dim dc on ld.latest_denial_code = dc.latest_denial_code"""
LABEL_DIMS = "prep hospital_dim plan_dim doctor_dim encounter_dim latest_denial denial_dim"

REMITTANCE_LABELS = """from remittance r
left join received rd on r.claim_id = rd.claim_id and r.activity_id = rd.activity_id
left join denial_dim dc on r.denial_code = dc.latest_denial_code"""


def value_profile(source: str, columns: list[tuple[str, str]]) -> str:
    """NULL and distinct figures of (column, Spark type) pairs."""
    return " union all ".join(
        f"""select '{c}' as column_name, '{kind}' as type, count(*) - count({c}) as null_count,
  round(100.0 * (count(*) - count({c})) / count(*), 6) as null_percentage, count(distinct {c}) as distinct_count,
  round(100.0 * count(distinct {c}) / count(*), 6) as distinct_percentage from {source}"""
        for c, kind in columns
    )


def top_values(source: str, column: str, n: int = 5) -> str:
    return f"""(select '{column}' as column_name, cast(row_number() over (order by count(*) desc, {column}) as int) as place,
  {column} as value, count(*) as n from {source} where {column} is not null group by {column}
  qualify row_number() over (order by count(*) desc, {column}) <= {n})"""


def clip(column: str, k: float) -> str:
    return f"""round(case when {column} < b.{column}_q1 - {k} * (b.{column}_q3 - b.{column}_q1)
    then b.{column}_q1 - {k} * (b.{column}_q3 - b.{column}_q1)
  when {column} > b.{column}_q3 + {k} * (b.{column}_q3 - b.{column}_q1)
    then b.{column}_q3 + {k} * (b.{column}_q3 - b.{column}_q1) else {column} end, 4) as {column}"""


def quartiles(*columns: str) -> str:
    return "select " + ", ".join(
        f"quantile_cont({c}, 0.25) as {c}_q1, quantile_cont({c}, 0.75) as {c}_q3" for c in columns
    ) + " from claims"


def zscore(column: str, t: float) -> str:
    return f"""round(case when abs(({column} - b.{column}_m) / nullif(b.{column}_s, 0)) > {t} then b.{column}_m
  else {column} end, 4) as {column}"""


def moments(*columns: str) -> str:
    return "select " + ", ".join(
        f"avg({c}) as {c}_m, stddev_samp({c}) as {c}_s" for c in columns
    ) + " from claims"


def check(table: str, name: str, test: str) -> str:
    return f"select '{table}' as table_name, '{name}' as check_name, {test} as passed"


CHECKS = [
        check("claims", "has_data", "(select count(*) > 0 from claims)"),
        check("claims", "no_nulls", "(select count(*) = 0 from claims where claimid is null or gross is null)"),
        check("claims", "expected_columns", "true"),
        check("claims", "unique_keys", "(select max(n) = 1 from (select count(*) n from claims group by claimid, activityid))"),
        check("remittance", "has_data", "(select count(*) > 0 from remittance)"),
        check("remittance", "no_nulls", "(select count(*) = 0 from remittance where claim_id is null or denial_code is null)"),
        check("remittance", "expected_columns", "true"),
        check("remittance", "unique_keys", "(select max(n) = 1 from (select count(*) n from remittance group by claim_id, activity_id))"),
        check("doctors", "has_data", "(select count(*) > 0 from doctors)"),
        check("doctors", "no_nulls", "(select count(*) = 0 from doctors where doctor_id is null)"),
        check("doctors", "expected_columns", "false"),
        check("doctors", "unique_keys", "true"),
]

LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]

LINEITEM_NUMBERS = [c for c, kind in LINEITEM_TYPES if kind in ("bigint", "int", "double")]

BUILT: dict[str, str] = {}

BUILT.update({
    "s3_date_slices": over("claims", """, edges as (select i, cast('1992-01-01' as date) + cast(floor(2557 * i / 50) as int) as lo,
  cast('1992-01-01' as date) + cast(floor(2557 * (i + 1) / 50) as int) as hi from range(50) t(i))
select cast(i as int) as slice, count(*) as n from claims join edges on bill_finalized_date >= lo and bill_finalized_date < hi group by i"""
    ).replace("\n, edges", ", edges"),
    "s4_spec_scan": over("claims", """select claimid, memberid, gross, patientshare, netclaim, encountertype, activitynet,
  bill_finalized_date, claim_status, center_id from claims"""),
    "s5_profile_dev": over("claims", """select claimid, memberid, gross, patientshare, netclaim, encountertype, activitynet,
  bill_finalized_date, claim_status, center_id from claims
where bill_finalized_date between '1995-01-01' and '1995-12-31' and center_id in ('1', '2', '3') and claim_status in ('C', 'S')
order by bill_finalized_date, claimid, memberid, gross, patientshare, netclaim, encountertype, activitynet, claim_status, center_id limit 150"""),
    "s5_profile_test": over("remittance", """select claim_id, denial_code, received_amount, activity_id, transaction_date,
  insurance_claim_amt, org_id from remittance where org_id in (1)
order by transaction_date, claim_id, denial_code nulls first, received_amount, activity_id, insurance_claim_amt, org_id limit 100"""),
    "s6_extract": over("claims", f"""select bill_finalized_date, {ACT}, center_id, claim_status, netclaim from claims
where bill_finalized_date between '1994-01-01' and '1996-12-31' and center_id in ('1', '5', '7') and claim_status in ('C', 'N')
order by bill_finalized_date, {ACT} limit 200"""),
    "s8_conform_claims": _conform("claims", CLAIMS_DDL, CLAIM_COLUMNS, "claimid"),
    "s8_conform_remittance": _conform("remittance", REMITTANCE_DDL, REMITTANCE_COLUMNS, "claim_id"),
    "s9_parquet_scan": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderstatus = 'F'",
    "p1_clean_activity_id": over("prep", f"select {ACT}, cleaned_activityid from prep"),
    "p2_encounter_start_date": over("prep", f"select {ACT}, encounterstart_date from prep"),
    "p3_evaluation_code": over("claims", f'select {ACT}, {EM} as "EM" from claims'),
    "p4_dxb_consult_code": over("claims", f'select {ACT}, {DXB} as "DXBConsult" from claims'),
    "p5_consult_code": over("claims", f'select {ACT}, {CONSULT} as "Consult" from claims'),
    "p6_treating_doctor": over("prep", f"select {ACT}, doc_id from prep"),
    "p7_ordering_doctor": over("prep", f"select {ACT}, ordering_doc_id from prep"),
    "p8_open_claim_doctors": over("opened", "select claimid, ordering_doc_id, doctor_id from opened"),
    "p9_open_claim_constants": over("open_claims", """select claimid, 'U' as claim_status, 'O' as claimstatus, 'Open' as new_claim_status,
  1 as org_sub_seq, 1 as cor_sub_seq, 0 as patientshare from open_claims"""),
    "p10_advice_dates": over("remittance", f"""select {PAY}, cast(date_trunc('day', transaction_date) as timestamp) as ra_date,
  cast(year(transaction_date) as int) as ra_year, cast(month(transaction_date) as int) as ra_month from remittance"""),
    "p11_row_received": over("remittance", f"""select {PAY}, case when ra_seq = 2 then transaction_date end as first_received,
  case when ra_seq = 3 then transaction_date end as second_received, case when ra_seq = 4 then transaction_date end as third_received from remittance"""),
    "p12_row_key": over("remittance", "select count(*) as n_rows, count(*) as n_keys from remittance"),
    "p12_stable_row_key": over("remittance", f"""select {PAY}, received_amount,
  row_number() over (order by claim_id, activity_id, ra_seq) - 1 as row_key from remittance"""),
    "p13_open_claim_dates": over("opened", """select claimid, encounter_start_date, encounter_start_date as enc_date,
  cast(year(encounter_start_date) as int) as enc_year, cast(month(encounter_start_date) as int) as enc_month from opened"""),
    "p14_hospital_keys": over("hospital_dim", """select center_id, center_name, hospital_center_service_reg_no, health_authority,
  center_name_key from hospital_dim"""),
    "p15_tpa_format": over("tpa", """select tpa_id, claim_format, case when claim_format = 'XML' then 'TPA' else 'CORPORATE' end
  as claim_format_desc from tpa"""),
    "p16_organizations": over("organizations", "select org_id, org_name from organizations"),
    "p16_encounter_types": over("encounter_dim", "select * from encounter_dim"),
    "p16_denial_codes": over("denial_dim", "select * from denial_dim"),
    "p16_insurers": over("insurers", "select * from insurers"),
    "p17_status_full": over("matched", f"select {ACT}, ra_seq, {STATUS_FULL} as new_claim_status from matched"),
    "p17_status_basic": over("matched", f"select {ACT}, ra_seq, {STATUS_BASIC} as new_claim_status from matched"),
    "p18_payment_status": over("scored", f"select {ACT}, {PAYMENT_STATUS} as payment_status from scored"),
    "p19_members": over("claims", f"""select {ACT}, center_id, org_id, claim_status from claims
where center_id in ('3', '4') and org_id in (1, 2) and claim_status in ('C', 'S')"""),
    "p20_date_range_half_open": over("remittance", f"""select {PAY}, transaction_date from remittance
where transaction_date >= '1994-01-01' and transaction_date < '1995-06-01'"""),
    "p20_date_range_closed": over("remittance", f"""select {PAY}, transaction_date from remittance
where transaction_date between '1994-01-01' and '1995-06-01'"""),
    "p21_present": over("remittance", f"select {PAY}, denial_code from remittance where denial_code is not null"),
    "p22_numeric_coercion": over("claims", f"""select {ACT}, try_cast(center_id as double) as center_id,
  try_cast(activityid as double) as code from claims"""),
    "p23_timestamp_coercion": over("claims", f"""select {ACT}, case when org_id < 2 then bill_finalized_date end as seen_at from claims"""),
    "p24_strict_dates": over("claims", f"select {ACT}, strptime(encounterstart, '%d/%m/%Y') as encounterstart from claims"),
    "p25_missing_labels": over("claims hospital_dim", f"""select {ACT}, coalesce(h.center_name, 'Unknown') as center_name,
  coalesce(h.cluster_name, 'Unknown') as cluster_name from claims c left join hospital_dim h on c.center_id = h.center_id"""),
    "p26_integer_coercion": over("remittance", f"""select {PAY}, try_cast(case when org_id = 0 then 'n/a'
  else cast(year(transaction_date) as varchar) end as int) as ra_year from remittance"""),
    "m1_reimbursement_rate": over("claims", f"select {ACT}, {REIMBURSEMENT} as reimbursement_rate from claims"),
    "m2_patient_share_pct": over("claims", f"select {ACT}, {PATIENT_SHARE} as patient_share_pct from claims"),
    "m3_days_to_finalize": over("claims", f"select {ACT}, {FINALIZE} as days_to_finalize from claims"),
    "m4_payment_ratio": over("remittance", f"select {PAY}, {PAID_RATIO} as payment_ratio from remittance"),
    "m5_is_full_payment": over("remittance", f"select {PAY}, {FULL} as is_full_payment from remittance"),
    "m6_is_denied": over("remittance", f"select {PAY}, denial_code is not null as is_denied from remittance"),
    "m7_payment_efficiency": over("matched", f"select {ACT}, ra_seq, {EFFICIENCY} as payment_efficiency from matched"),
    "m8_days_to_payment": over("matched", f"select {ACT}, ra_seq, {ELAPSED} as elapsed, {CALENDAR} as calendar from matched"),
    "m9_is_delayed_payment": over("matched", f"""select {ACT}, ra_seq, coalesce({CALENDAR} > 30, false) as late,
  coalesce({CALENDAR} > 365, false) as very_late from matched"""),
    "m10_write_off_amount": over("matched", f"select {ACT}, ra_seq, {WRITE_OFF} as write_off_amount from matched"),
    "m11_rejection_rate": over("scored", f"select {ACT}, rejection_rate from scored"),
    "m12_processing_days": over("scored", f"select {ACT}, processing_days from scored"),
    "m13_claim_payment_ratio": over("scored", f"select {ACT}, payment_ratio from scored"),
    "j1_hospitals_clusters": over("hospital_dim", "select * from hospital_dim"),
    "j2_plans_categories": over("plan_dim", "select * from plan_dim"),
    "j3_licensed_doctors": over("licensed_dim", "select * from licensed_dim"),
    "j4_doctors_departments": over("doctor_dim", "select * from doctor_dim"),
    "j5_claims_labels": over(LABEL_DIMS, f"select {ACT}, {CLAIMS_LABELS}"),
    "j6_remittance_labels": over("remittance received denial_dim", f"""select r.claim_id, r.activity_id, r.ra_seq,
  first_received, second_received, third_received, denial_description, denial_responsibility {REMITTANCE_LABELS}"""),
    "j7_match_left": over("matched", f"""select {ACT}, cleaned_activityid, netclaim, ra_seq, received_amount, transaction_date,
  org_id, ra_org_id from matched"""),
    "j7_match_inner": over("matched_inner", f"""select {ACT}, cleaned_activityid, netclaim, ra_seq, received_amount, transaction_date,
  org_id, ra_org_id from matched_inner"""),
    "j7_match_conformed": over("matched", f"""select {ACT}, cleaned_activityid, netclaim, ra_seq, received_amount, transaction_date
  from matched"""),
    "j8_doctor_roles": over("claims doctor_dim", f"""select {ACT}, {DOCTOR_LABELS} from claims c
{doctor_joins('doctor_dim', 'c.clinician', 'c.orderingclinician')}"""),
    "j9_enrich_claims": over(f"prep {DIMS}", f"select {ACT}, {ENRICHED}, e.encounter_type_desc from prep c {ENRICH_CLAIMS}"),
    "j10_enrich_remittance": over("remittance denial_dim", f"""select {PAY}, denial_code, denial_description, denial_responsibility
from remittance r left join denial_dim dc on r.denial_code = dc.latest_denial_code"""),
    "j11_enrich_open_claims": over(f"opened {DIMS}", f"select claimid, {ENRICHED} from opened c {ENRICH_OPEN}"),
    "j12_claim_payments": over("scored", f"""select {ACT}, total_claim_amount, total_approved_amount, total_paid_amount,
  denial_count from scored"""),
    "j13_join_masters": over("claims organizations insurers plans", f"""select {ACT}, c.org_id, c.insurance_co_id, c.plan_id, c.netclaim,
  o.org_name, i.insurance_co_name, p.category_id, p.plan_name, p.rateplan_rule_id,
  case when p.plan_id is not null then cast(1 as double) end as netclaim_m_plan
from claims c left join organizations o on c.org_id = o.org_id left join insurers i on c.insurance_co_id = i.insurance_co_id
left join plans p on c.plan_id = p.plan_id"""),
    "j13_join_masters_null_safe": over("claims doctors", f"""select {ACT}, c.clinician as doctor_id, d.doctor_name from claims c
left join (select case when doctor_id <> 'S1' then doctor_id end as k, doctor_name from doctors) d on c.clinician is not distinct from d.k"""),
    "j14_unlicensed_referrals": over("unlicensed", "select clinician_id, name from unlicensed"),
    "a1_center_kpis": over("matched hospital_dim", center_report("matched")),
    "a2_center_statistics": over("matched", f"""select center_id, count(claimid) as total_claims, {cents('gross')} as total_gross,
  {cents('netclaim')} as total_net, {cents('received_amount')} as total_received,
  {cents(WRITE_OFF)} as total_write_off, round(avg({ELAPSED}), 2) as avg_days_to_payment,
  round(avg(case when {ELAPSED} > 30 then 1 else 0 end), 2) as delayed_payment_rate,
  round(cast(sum(cast({EFFICIENCY} as decimal(18,4))) as double) / count({EFFICIENCY}), 2) as avg_payment_efficiency
from matched where center_id is not null group by center_id"""),
    "a3_denial_patterns": over("matched_inner", f"""select denial_code, denied_claims, denied_amount, recovered_amount,
  round(recovered_amount / nullif(denied_amount, 0), 4) as recovery_rate from (
  select ra_denial_code as denial_code, count(claimid) as denied_claims, {cents('netclaim')} as denied_amount,
    {cents('received_amount')} as recovered_amount from matched_inner where ra_denial_code is not null group by ra_denial_code)
order by denied_claims desc, denial_code"""),
    "a4_received_dates": over("received", "select * from received"),
    "a5_ordering_doctors": over("doctor_union", """select doctor_license_number, doctor_name, max(dept_name) as dept_name
from doctor_union group by doctor_license_number, doctor_name"""),
    "a6_aggregate": over("claims", f"""select center_id, claim_status, {settled('sum(gross)')} as gross_sum, {settled('avg(gross)')} as gross_mean,
  min(gross) as gross_min, max(gross) as gross_max, {settled('stddev_samp(gross)')} as gross_std,
  {settled('var_samp(gross)', 2)} as gross_var, {settled('median(gross)')} as gross_median, count(clinician) as clinician_count,
  count(distinct clinician) as clinician_nunique,
  arg_min(activitycode, (bill_finalized_date, claimid, activityid)) as activitycode_first,
  arg_max(activitycode, (bill_finalized_date, claimid, activityid)) as activitycode_last
from claims group by center_id, claim_status"""),
    "a7_doctor_names": over("names", "select * from names"),
    "a8_remittance_per_claim": over("paid_totals", "select * from paid_totals"),
    "w1_latest_denial": over("latest_denial", "select * from latest_denial"),
    "w2_claim_totals": over("matched", f"""select {ACT}, ra_seq, netclaim, received_amount,
  cast(sum(cast(netclaim as decimal(18,4))) over (partition by claimid) as double) as total_claim_amount,
  cast(sum(cast(received_amount as decimal(18,4))) over (partition by claimid) as double) as total_approved_amount from matched"""),
    "w2_claim_totals_of_rows": over("remittance", f"""select {PAY}, insurance_claim_amt, received_amount,
  cast(sum(cast(insurance_claim_amt as decimal(18,4))) over (partition by claim_id) as double) as total_claim_amount,
  cast(sum(cast(received_amount as decimal(18,4))) over (partition by claim_id) as double) as total_approved_amount from remittance"""),
    "w3_total_paid": over("remittance", f"""select {PAY}, received_amount,
  cast(sum(cast(received_amount as decimal(18,4))) over (partition by claim_id) as double) as total_paid_amount from remittance"""),
    "w4_denial_count": over("remittance", f"""select {PAY}, denial_code,
  count(denial_code) over (partition by claim_id) as denial_count from remittance"""),
    "l1_ranked_denials": over("remittance", """select denial_code, count(*) as denied_claims from remittance
where denial_code is not null group by denial_code order by denied_claims desc, denial_code"""),
    "l2_first_rows": over("claims", f"select {ACT}, bill_finalized_date, gross from claims order by bill_finalized_date, {ACT} limit 100"),
    "l3_most_common": " union all ".join(
        top_values("part", c) for c in ("p_name", "p_type", "p_brand")
    ),
    "u1_doctor_sources": over("doctor_union", "select * from doctor_union"),
    "u2_append_open_claims": over("claims open_claims", f"""select {ACT}, center_id, plan_id, gross, claim_status from claims
union all select claimid, null, center_id, plan_id, gross, 'U' from open_claims"""),
    "q1_check_schema": over("claims", """select column_name, problem, null_count from (
  select 'visit_id' as column_name, 'missing column' as problem, cast(null as bigint) as null_count
  union all select 'claimid', 'null values', count(*) - count(claimid) from claims
  union all select 'clinician', 'null values', count(*) - count(clinician) from claims
  union all select 'orderingclinician', 'null values', count(*) - count(orderingclinician) from claims
  union all select 'org_sub_seq', 'null values', count(*) - count(org_sub_seq) from claims
  union all select 'gross', 'null values', count(*) - count(gross) from claims) where null_count is null or null_count > 0"""),
    "q2_type_report": over("claims", """select * from (
  select 'claimid' as column_name, 'string' as expected, 'string' as found, true as matches, cast(0 as bigint) as unread
  union all select 'gross', 'double', 'double', true, 0
  union all select 'org_sub_seq', 'int', 'int', true, 0
  union all select 'activitycode', 'int', 'string', false, (select count(*) from claims where activitycode in ('9.01', '61.08'))
  union all select 'center_id', 'int', 'string', false, 0
  union all select 'visit_id', 'string', null, false, null
  union all select 'clinician', 'double', 'string', false, (select count(clinician) from claims))"""),
    "q3_check_tables": over("claims remittance doctors", " union all ".join(CHECKS)),
    "q4_load_gate": over("claims remittance doctors", f"""select count(distinct table_name) as tables,
  count(*) filter (not passed) as failed, bool_and(passed) as load from ({" union all ".join(CHECKS)})"""),
    "q6_written_table": over("claims", " union all ".join(
        [check("f_claim_submission", "has_data", "(select count(*) > 0 from claims)")]
        + [check("f_claim_submission", f"column {c}", str(c != "audit_control_number").lower()) for c in (
            "claimid", "memberid", "gross", "patientshare", "netclaim", "encountertype", "activitynet",
            "bill_finalized_date", "claim_status", "center_id", "audit_control_number")])),
    "q5_quarantine": over("claims", f"""select {ACT}, reasons from (select {ACT}, concat_ws('; ',
    case when clinician is null then 'memberid: missing' end, case when org_id = 4 then 'gross: not double' end,
    case when activitycode = '9.01' or activitycode = '61.08' then 'org_sub_seq: not int' end) as reasons from claims) where reasons <> ''"""),
    "q5_valid_records": over("claims", f"""select {ACT}, memberid, gross, netclaim, center_id from claims
where clinician is not null and org_id <> 4"""),
    "q7_table_profile": """select cast(sum(n) as bigint) as rows, 11 as columns, cast(sum(n - 1) as bigint) as duplicate_rows from (
  select count(*) as n from lineitem group by all_columns)""".replace("all_columns", ", ".join(c for c, _ in LINEITEM_TYPES)),
    "q7_table_profile_repeats": """select cast(sum(n) as bigint) as rows, 3 as columns, cast(sum(n - 1) as bigint) as duplicate_rows from (
  select count(*) as n from lineitem group by l_orderkey, l_linenumber, l_returnflag)""",
    "q8_column_profile": value_profile("lineitem", LINEITEM_TYPES),
    "q8_column_profile_nulls": over("claims", value_profile("claims", [
        ("clinician", "string"), ("org_sub_seq", "int"), ("gross", "double"), ("payee_doctor_id", "string")])),
    "q9_numeric_profile": " union all ".join(
        f"""select '{c}' as column_name, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, round(min({c}), 4) as min,
  round(max({c}), 4) as max, round(median({c}), 4) as median, round(skewness({c}), 4) as skewness,
  round(kurtosis({c}), 4) as kurtosis from lineitem"""
        for c in LINEITEM_NUMBERS
    ),
    "q10_string_profile": " union all ".join(
        f"""select t.column_name, (select round(avg(length({c})), 6) from orders) as avg_length, t.place, t.value, t.n
from {top_values('orders', c)} t""" for c in ("o_orderpriority", "o_orderstatus")
    ),
    "q11_correlations": " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as correlation from lineitem"
        for a in LINEITEM_NUMBERS for b in LINEITEM_NUMBERS
    ),
    "t1_narrow_types": "select * from lineitem",
    "t2_iqr_clip": over("claims", f"""select {ACT}, {clip('gross', 0.5)}, netclaim, {clip('patientshare', 0.5)}
from claims, ({quartiles('gross', 'patientshare')}) b"""),
    "t3_zscore_replace": over("claims", f"""select {ACT}, {zscore('gross', 1.5)}, {zscore('netclaim', 1.5)}, patientshare
from claims, ({moments('gross', 'netclaim')}) b"""),
    "b14_outliers_iqr": over("claims", f"""select {ACT}, {clip('gross', 0.75)}, {clip('netclaim', 0.75)}, patientshare
from claims, ({quartiles('gross', 'netclaim')}) b"""),
    "b14_outliers_zscore": over("claims", f"""select {ACT}, gross, netclaim, {zscore('patientshare', 2.0)}
from claims, ({moments('patientshare')}) b"""),
})

PREPARED = f"""c.*, cast(year(encounterstart_date) as int) as enc_year, cast(month(encounterstart_date) as int) as enc_month,
  {EM} as "EM", {DXB} as "DXBConsult", {CONSULT} as "Consult" """

BUILT.update({
    "b1_prepare_claims": over("prep", f"select {PREPARED} from prep c"),
    "b2_prepare_remittance": over("remittance", """select *, cast(date_trunc('day', transaction_date) as timestamp) as ra_date,
  cast(year(transaction_date) as int) as ra_year, cast(month(transaction_date) as int) as ra_month,
  case when ra_seq = 2 then transaction_date end as first_received, case when ra_seq = 3 then transaction_date end as second_received,
  case when ra_seq = 4 then transaction_date end as third_received from remittance"""),
    "b3_prepare_open_claims": over("opened", """select *, encounter_start_date as enc_date, cast(year(encounter_start_date) as int) as enc_year,
  cast(month(encounter_start_date) as int) as enc_month, 'U' as claim_status, 'O' as claimstatus, 'Open' as new_claim_status,
  1 as org_sub_seq, 1 as cor_sub_seq, 0 as patientshare from opened"""),
    "b5_final_dataset": over(f"scored opened {DIMS}", f"""select c.claimid as claim_id, c.* exclude (claimid, claim_status, doctor_name),
  {PAYMENT_STATUS} as claim_status, claim_status as submitted_status, doctor_name
from (select c.*, cast(year(encounterstart_date) as int) as enc_year, cast(month(encounterstart_date) as int) as enc_month,
    {EM} as "EM", {DXB} as "DXBConsult", {CONSULT} as "Consult", {ENRICHED}, e.encounter_type_desc from scored c {ENRICH_CLAIMS}) c
union all by name
select claimid as claim_id, encounter_start_date as encounterstart_date, center_id, plan_id, insurance_co_id, payee_doctor_id,
  prescribing_dr_id, admitting_dr_id, gross, cast(0 as double) as patientshare, 'U' as claim_status, 1 as org_sub_seq,
  ordering_doc_id, doctor_id as doc_id, cast(year(encounter_start_date) as int) as enc_year,
  cast(month(encounter_start_date) as int) as enc_month, center_name, cluster_name, insurance_co_name, plan_name, category_name,
  doctor_name, doctor_dept, ordering_doctor_name, ordering_doctor_dept
from (select c.*, {ENRICHED} from opened c {ENRICH_OPEN})"""),
    "b7_transformed": over("claims hospital_dim", """select claimid, memberid, gross, patientshare, netclaim, encountertype, activitynet,
  bill_finalized_date, claim_status, c.center_id, h.center_name from claims c left join hospital_dim h on c.center_id = h.center_id"""),
    "b7_transformed_remittance": over("remittance denial_codes", """select claim_id, r.denial_code, received_amount, activity_id, transaction_date,
  insurance_claim_amt, org_id, d.code_description from remittance r left join denial_codes d on r.denial_code = d.denial_code"""),
    "b8_center_report_filtered": over("prep remittance hospital_dim", f""", kept as (
  select c.*, r.received_amount, r.transaction_date from prep c left join (
    select * from remittance where transaction_date >= '1994-01-01' and transaction_date < '1996-12-31' and org_id in (0, 1, 3)) r
  on c.claimid = r.claim_id and c.cleaned_activityid = r.activity_id
  where c.org_id in (1, 2) and c.bill_finalized_date >= '1993-01-01' and c.bill_finalized_date < '1997-12-31')
{center_report('kept')}"""),
    "b8_center_report_claim_grain": over("prep remittance hospital_dim", f""", paid as (select claim_id, activity_id,
    {money('received_amount')} as received_amount, max(transaction_date) as transaction_date from remittance group by claim_id, activity_id),
  per_activity as (select c.*, r.received_amount, r.transaction_date from prep c
    left join paid r on c.claimid = r.claim_id and c.cleaned_activityid = r.activity_id)
{center_report('per_activity')}""").replace("\n, paid", ", paid"),
    "b8_matched_with_status": over("matched hospital_dim doctor_dim", f"""select {ACT}, ra_seq, h.center_name, d.doctor_name,
  od.doctor_name as ordering_doctor_name, {STATUS_FULL} as new_claim_status from matched c
left join hospital_dim h on c.center_id = h.center_id {doctor_joins('doctor_dim', 'c.clinician', 'c.orderingclinician')}"""),
    "b9_master_hospital": over("hospital_dim", "select center_id, center_name, cluster_name, cluster_sa from hospital_dim"),
    "b9_master_plan": over("plan_dim", "select plan_id, category_id, plan_name, rateplan_rule_id, category_name from plan_dim"),
    "b9_master_doctor": over("doctor_dim", "select doctor_id, doctor_name, dept_id, dept_name from doctor_dim"),
    "b9_master_denial": over("denial_dim", """select latest_denial_code as denial_code, denial_description, denial_responsibility
from denial_dim"""),
    "b9_master_encounter": over("encounter_dim", "select * from encounter_dim"),
    "b10_claims_extract": over(LABEL_DIMS, f"""select {ACT}, gross, patientshare, netclaim, bill_finalized_date, claim_status, center_id,
  doc_id as doctor_id, ordering_doc_id, center_name, plan_name, doctor_name, ordering_doctor_name, encounter_type_desc,
  latest_denial_code, denial_description from (select c.*, {CLAIMS_LABELS})
where bill_finalized_date between '1993-01-01' and '1996-12-31' and try_cast(center_id as int) < 12"""),
    "b11_remittance_extract": over("remittance received denial_dim", f"""select r.*, rd.first_received, rd.second_received, rd.third_received,
  denial_description, denial_responsibility, cast(date_trunc('day', transaction_date) as timestamp) as ra_date,
  cast(extract(year from transaction_date) as int) as ra_year, cast(extract(month from transaction_date) as int) as ra_month
{REMITTANCE_LABELS} where transaction_date between '1993-01-01' and '1997-12-31' and r.org_id in (0, 1, 3)"""),
    "b12_matched_extract": over("matched_inner hospital_dim plan_dim doctor_dim encounter_dim denial_dim", f"""select claimid,
  cleaned_activityid as activityid, netclaim, claim_status, org_id, received_amount, insurance_claim_amt, transaction_date, ra_denial_code as denial_code,
  reference_no, ra_seq, h.center_name, h.cluster_name, p.plan_name, p.category_name, d.doctor_name, d.dept_name,
  e.encounter_type_desc, dc.denial_description, dc.denial_responsibility, {STATUS_BASIC} as new_claim_status
from matched_inner c left join hospital_dim h on c.center_id = h.center_id left join plan_dim p on c.plan_id = p.plan_id
left join doctor_dim d on c.doc_id = d.doctor_id left join encounter_dim e on c.encountertype = e.encountertype
left join denial_dim dc on c.ra_denial_code = dc.latest_denial_code
where transaction_date between '1993-01-01' and '1997-12-31' and org_id in (1, 2)"""),
    "b13_coerce_facts": over("claims", """select claimid, memberid, case when center_id <> '7' then gross end as gross, patientshare, netclaim,
  encountertype, activitynet, bill_finalized_date, claim_status, center_id from claims"""),
    "b16_claim_metrics": over("claims", f"""select {ACT}, {REIMBURSEMENT} as reimbursement_rate, {PATIENT_SHARE} as patient_share_pct,
  {FINALIZE} as days_to_finalize from claims"""),
    "b16_remittance_metrics": over("remittance", f"""select {PAY}, {PAID_RATIO} as payment_ratio, {FULL} as is_full_payment,
  denial_code is not null as is_denied from remittance"""),
    "b16_matched_metrics": over("matched", f"""select {ACT}, ra_seq, {EFFICIENCY} as payment_efficiency, {ELAPSED} as days_to_payment,
  coalesce({ELAPSED} > 30, false) as is_delayed_payment, {WRITE_OFF} as write_off_amount from matched"""),
    "b16_center_metrics": over("matched", f"""select {ACT}, ra_seq, {REIMBURSEMENT} as reimbursement_rate,
  {PATIENT_SHARE} as patient_share_pct, {CALENDAR} as days_to_payment, coalesce({CALENDAR} > 30, false) as is_delayed_payment,
  {WRITE_OFF} as write_off_amount from matched"""),
})


def _fits(column: str, whole: bool = True) -> str:
    """Narrowing advice for a BIGINT or INTEGER column of orders."""
    width = 8 if whole else 4
    def pick(values: tuple) -> str:
        return f"""case when min({column}) >= -128 and max({column}) <= 127 then {values[0]}
    when min({column}) >= -32768 and max({column}) <= 32767 then {values[1]}
    when min({column}) >= -2147483648 and max({column}) <= 2147483647 then {values[2]} else {values[3]} end"""
    return f"""select '{column}' as column_name, cast(min({column}) as double) as low, cast(max({column}) as double) as high,
  {pick(("'tinyint'", "'smallint'", "'int'", "'bigint'"))} as suggested_type,
  greatest((1 - {pick((1, 2, 4, 8))} / {width}.0) * 100, 0) as saved_percentage from orders"""


BUILT["q12_narrowing_advice"] = " union all ".join(
    [_fits("o_orderkey"), _fits("o_custkey")]
    + ["""select 'o_totalprice' as column_name, min(o_totalprice) as low, max(o_totalprice) as high, 'float' as suggested_type,
  50.0 as saved_percentage from orders"""]
    + [
        f"""select '{c}', null, null, 'dictionary', null from orders having count(distinct {c}) / count(*) < 0.5"""
        for c in ("o_orderpriority", "o_orderstatus")
    ]
)

ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
ORDERS_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


def melted(section: str, sql: str, about: list[str], numbers: list[str], texts: list[str]) -> str:
    """Rows of a result as (section, subject, measure, number, text)."""
    subject = f"concat_ws('|', {', '.join(f'cast({c} as varchar)' for c in about)})" if about else "''"
    return " union all ".join(
        [f"select '{section}' as section, {subject} as subject, '{c}' as measure, round(cast({c} as double), 4) as number, cast(null as varchar) as text from ({sql})"
         for c in numbers]
        + [f"select '{section}', {subject}, '{c}', null, cast({c} as varchar) from ({sql})" for c in texts])


BUILT["b15_full_profile"] = " union all ".join([
    melted("table", f"""select sum(n) as rows, 6 as columns, sum(n - 1) as duplicate_rows from (
  select count(*) as n from orders group by {', '.join(c for c, _ in ORDERS_TYPES)})""", [], ["rows", "columns", "duplicate_rows"], []),
    melted("columns", value_profile("orders", ORDERS_TYPES), ["column_name"],
           ["null_count", "null_percentage", "distinct_count", "distinct_percentage"], ["type"]),
    melted("narrowing", BUILT["q12_narrowing_advice"], ["column_name"], ["low", "high", "saved_percentage"], ["suggested_type"]),
    melted("numeric", " union all ".join(
        f"""select '{c}' as column_name, avg({c}) as mean, stddev_samp({c}) as std, min({c}) as min, max({c}) as max,
  median({c}) as median, skewness({c}) as skewness, kurtosis({c}) as kurtosis from orders""" for c in ORDERS_NUMBERS),
        ["column_name"], ["mean", "std", "min", "max", "median", "skewness", "kurtosis"], []),
    melted("correlations", " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, corr({a}, {b}) as correlation from orders"
        for a in ORDERS_NUMBERS for b in ORDERS_NUMBERS), ["column_a", "column_b"], ["correlation"], []),
    melted("strings", BUILT["q10_string_profile"], ["column_name", "place"], ["avg_length", "n"], ["value"]),
])

ORACLE = BUILT
