"""The same queries as DuckDB SQL over the given tables."""

from __future__ import annotations

from registry.queries import ADHOC

K = "cast(json_extract_string(props, '$.k') as int)"

WIN = f"""
win as (
  select event_id, ts, concat('host', cast(user_id as varchar)) devicehostname,
    case when user_id % 29 = 0 then ''
         when user_id % 31 = 0 then concat('host', cast(user_id as varchar))
         else concat('10.0.0.', cast(user_id % 40 as varchar)) end deviceaddress,
    case event_type when 'signup' then '4624' when 'error' then '4625' when 'click' then '4688'
                    when 'view' then '4656' else '4672' end windowseventid,
    case when {K} % 5 = 0 then 'powershell.exe' when {K} % 5 = 1 then 'job.ps1.bak' else 'cmd.exe' end windowsprocessname,
    case when {K} % 2 = 0 then 'File' else 'Network' end windowslogontype,
    value > 60 is_alert,
    case when {K} % 3 = 0 then 'is_nu' when {K} % 3 = 1 then '' else null end alerts_nu,
    case when {K} % 4 = 0 then 'is_ne' else null end alerts_ne,
    cast(year(ts) as int) y, cast(month(ts) as int) m, cast(day(ts) as int) d
  from events)"""

SCRIPT = """((windowseventid in ('4688') and regexp_matches(windowsprocessname, 'powershell\\.exe|powershell_ise\\.exe|pwsh\\.exe'))
  or (windowseventid in ('4656', '4663') and windowslogontype = 'File'
      and regexp_matches(windowsprocessname, '\\.ps1\\.|\\.psd1\\.|\\.psm1\\.|\\.ps1xm1\\.|\\.clixml\\.|\\.psc1\\.|\\.pssc\\.')))"""


def _count(condition: str, name: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint) {name}"


_COUNTS = ", ".join(
    [
        "count(*) total_events",
        _count("is_alert and alerts_nu is not null and alerts_nu <> ''", "is_nu_alert_count"),
        _count("is_alert and alerts_ne is not null and alerts_ne <> ''", "is_ne_alert_count"),
        _count("windowseventid in ('4624', '4634')", "logins_count"),
        _count("windowseventid in ('4656', '4659')", "fileactivity_count"),
        _count("windowseventid in ('4625', '4634')", "failedlogin_count"),
        _count("windowseventid in ('4688')", "other_scripts_count"),
        _count("windowseventid in ('4672', '4707')", "pri_count"),
        _count(SCRIPT, "ps_count"),
    ]
)
_NAMED = "devicehostname is not null and devicehostname <> '' and deviceaddress is not null and deviceaddress <> ''"

AGG = f"""{WIN},
agg as (
  select devicehostname as name, 'user' as type, y, m, d, {_COUNTS} from win where {_NAMED} group by devicehostname, y, m, d
  union all
  select deviceaddress as name, 'entity' as type, y, m, d, {_COUNTS} from win where {_NAMED} group by deviceaddress, y, m, d)"""

SCORES = f"""{AGG},
parts as (
  select *, 'day' time_window, concat('logins=', cast(logins_count as varchar)) zscore,
    case when d % 7 = 0 then null else cast((logins_count * 17 + total_events * 3) % 101 as double) end pas_kmeans,
    cast((failedlogin_count * 31 + total_events * 5) % 101 as double) pas_isolation,
    case when total_events = 1 then null else cast((other_scripts_count * 13 + total_events * 7) % 101 as double) end pas_svm
  from agg),
scores as (
  select *, round((coalesce(pas_kmeans, 0) + coalesce(pas_isolation, 0) + coalesce(pas_svm, 0))
    / ((pas_kmeans is not null)::int + (pas_isolation is not null)::int + (pas_svm is not null)::int), 4) pas
  from parts)"""


def _alert_rows(minus_low: bool = False) -> str:
    def score(side: str) -> str:
        low = f" - low_{side}" if minus_low else ""
        return (
            f"case when range_{side} = 0 then 0e0 else round(((a.is_{side}_alert_count{low})::double / range_{side}) * 100, 2) end"
            f" is_{side}_alert_score"
        )

    return f"""
ranges as (
  select y, m, d, min(is_nu_alert_count) low_nu, max(is_nu_alert_count) - min(is_nu_alert_count) range_nu,
    min(is_ne_alert_count) low_ne, max(is_ne_alert_count) - min(is_ne_alert_count) range_ne
  from agg group by y, m, d),
alrt as (
  select a.name, a.type, a.y, a.m, a.d, a.total_events, a.is_nu_alert_count, a.is_ne_alert_count, {score("nu")}, {score("ne")}
  from agg a join ranges b on a.y = b.y and a.m = b.m and a.d = b.d)"""


def _final(extra: str = "") -> str:
    return f"""with {SCORES}, {_alert_rows()}
select p.name, p.type, p.y, p.m, p.d, p.time_window, p.failedlogin_count, p.fileactivity_count, p.logins_count,
  p.other_scripts_count, p.pri_count, p.ps_count, t.total_events win_total_events,
  t.is_nu_alert_count total_is_nu_alert_count, t.is_ne_alert_count total_is_ne_alert_count,
  round((t.is_nu_alert_count::double / t.total_events) * 100, 2) is_nu_alert_ratio,
  round((t.is_ne_alert_count::double / t.total_events) * 100, 2) is_ne_alert_ratio,
  p.pas_kmeans win_kmeans_pas, p.pas_isolation win_isf_pas, p.pas_svm win_svm_pas, p.zscore win_zscore,
  p.pas win_profile_anomaly_score, t.is_nu_alert_score, t.is_ne_alert_score,
  round(p.pas * 0.6e0 + t.is_nu_alert_score * 0.2e0 + t.is_ne_alert_score * 0.2e0, 2) overall_anomaly_score
from scores p left join alrt t on p.name = t.name and p.y = t.y and p.m = t.m and p.d = t.d {extra}"""


COUNTERS = ["failedlogin_count", "fileactivity_count", "logins_count", "other_scripts_count", "pri_count", "ps_count"]


def _sum_counters() -> str:
    return ", ".join(f"cast(sum({c}) as bigint) {c}" for c in COUNTERS)


def _zscore(c: str) -> str:
    over = "over (partition by type, y, m, d)"
    sd = f"stddev_samp({c}) {over}"
    return f"case when {sd} > 0 then round(({c} - avg({c}) {over}) / {sd}, 4) end z_{c}"


def _distance(columns: list[str], centre: list[float]) -> str:
    return "sqrt(" + " + ".join(f"power({c} - {v}::double, 2)" for c, v in zip(columns, centre)) + ")"


def _clamped(value: str, low: str, high: str) -> str:
    return f"greatest(0e0, least(100e0, ({value} - {low}) / ({high} - {low}) * 100e0))"


def _squared(centre: list[float]) -> str:
    return "(" + " + ".join(f"({c} - {v}) * ({c} - {v})" for c, v in zip(COUNTERS, centre)) + ")"


STORED_SCORES = f"""with {SCORES}
      select name, type, time_window, 1700000000000::bigint execution_timestamp, {", ".join(COUNTERS)}, zscore,
        coalesce(pas_kmeans, 0) pas_kmeans, coalesce(pas_isolation, 0) pas_isolation, coalesce(pas_svm, 0) pas_svm,
        coalesce(pas, 0) pas, y, m, d from scores"""

CENTRES = ([0, 0, 0, 0, 0, 0], [1, 2, 1, 0, 3, 1], [4, 1, 0, 2, 2, 0])
SED = " + ".join(_distance(COUNTERS, c) for c in CENTRES)
FOREST = """(
  case when logins_count <= 1.5 then (case when pri_count <= 0.5 then 3.7 else 2.0 end) else 1.9 end
  + case when fileactivity_count <= 2.5 then 5.25 else (case when failedlogin_count <= 0.5 then 3.0 else 2.5 end) end
  + case when other_scripts_count <= 0.5 then 6.5 else 4.25 end)::double"""
PATH_256 = "(2e0 * (ln(255e0) + 0.5772156649015329e0) - 2e0 * 255e0 / 256e0)"


def _kernel(centre: list[float]) -> str:
    return "exp(-0.1e0 * (" + " + ".join(f"power({c} - {v}, 2)" for c, v in zip(COUNTERS, centre)) + "))"


MESSAGES = f"""
msg as (
  select event_id, ts, concat('u', cast(user_id as varchar)) user_name, concat('10.0.0.', cast(user_id % 40 as varchar)) src_ip,
    event_type, case when {K} % 10 = 0 then 0e0 else value end num1, cast({K} as double) num2,
    case when {K} % 7 = 0 then '' else event_type end cat1,
    case when value > 60 then concat('is_nu=', case when {K} % 2 = 0 then 'true' else 'false' end,
      ',is_ne=', case when {K} % 3 = 0 then 'true' else 'false' end,
      ',is_nwpu=', case when {K} % 5 = 0 then 'true' else 'false' end) end alerts,
    case when value > 60 then round(((case when {K} % 2 = 0 then 3e0 else 0e0 end) + (case when {K} % 3 = 0 then 2e0 else 0e0 end)
      + (case when {K} % 5 = 0 then 1e0 else 0e0 end)) * 100e0 / 6e0, 4) end alert_score
  from events)"""

_EVENT_SED = " + ".join(
    _distance(["((num1 - 50e0) / 48e0)", "((num2 - 49.5e0) / 29e0)"], c) for c in ([0, 0], [1, 1], [-1, 0.5], [2, -1])
)
EVENT_SCORES = f"""with {MESSAGES}
select cast(event_id as varchar) guid, cast(epoch_us(ts) // 1000 as bigint) as timestamp, user_name, src_ip entity_name,
  'demo_traffic' source_type, alerts, alert_score, round({_clamped(_EVENT_SED, '4e0', '30e0')}, 6) event_score,
  cast(year(ts) as int) y, cast(month(ts) as int) m, cast(day(ts) as int) d
from msg where event_type in ('click', 'view')"""


def _windows(name: str, seconds: int) -> str:
    start = f"epoch_us(ts) // 1000000 // {seconds} * {seconds}"
    return f"""select '{name}' time_window, cast({start} as bigint) window_start, user_id, count(*) events,
      cast(sum({K}) as bigint) total_k from events group by {start}, user_id"""


ATTRIBUTES = ["urgent", "high", "medium", "low", "not_specified"]


def _attribute_joins() -> str:
    one = "join (select actor, value as {a} from attrs where attribute = '{a}') t_{a} using (actor)"
    first, *rest = ATTRIBUTES
    return (
        f"(select actor, value as {first} from attrs where attribute = '{first}') t_{first} "
        + " ".join(one.format(a=a) for a in rest)
    )


ORACLE: dict[str, str] = {
    "profile_day_slice": f"with {AGG} select * from agg where y = 2024 and m = 1 and d = 15",
    "capped_projection": """select cast(l_orderkey as int) l_orderkey, l_linenumber, cast(l_partkey as int) l_partkey,
        cast(l_suppkey as int) l_suppkey, cast(trunc(l_extendedprice) as int) l_extendedprice
      from (select * from lineitem order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice limit 50000)""",
    "integer_projection": """select cast(l_orderkey as int) l_orderkey, cast(l_linenumber as int) l_linenumber,
        cast(l_partkey as int) l_partkey, cast(l_suppkey as int) l_suppkey, cast(trunc(l_extendedprice) as int) l_extendedprice
      from lineitem""",
    "event_timestamps": """select event_id, epoch_us(ts) // 1000 wall_ms, epoch_us(ts) // 1000 - 32400000 instant_ms from events""",
    "attribute_assembly_repeats": """with v as (
        select l_orderkey actor, lower(l_returnflag) a, case when l_linenumber <> 3 then cast(l_quantity as int) end n,
          case when l_linenumber = 3 then '?' else cast(cast(l_quantity as int) as varchar) end t from lineitem)
      select actor, cast(x.n as double) a, cast(y.n as double) r, z.t n
      from (select * from v where a = 'a') x join (select * from v where a = 'r') y using (actor)
        join (select * from v where a = 'n') z using (actor)""",
    "json_profile_scan": f"""with {AGG} select name user_name, type, y, m, d,
        case when total_events > 3 then 'True' else 'False' end increase_activity,
        case when pri_count > 0 then 'True' else 'False' end lateral_movement,
        logins_count logon_count, fileactivity_count inbound_conn_count, pri_count outbound_conn_count from agg""",
    "json_payload_rows": """select o_orderkey, concat('U', cast(o_custkey as varchar)) username, o_orderkey % 7 logins_count from orders
      union all select o_orderkey, concat('V', cast(o_custkey as varchar)), o_custkey % 5 from orders""",
    "attribute_assembly": f"""with attrs as (
        select concat('c', cast(o_custkey as varchar)) actor, lower(replace(substr(o_orderpriority, 3), ' ', '_')) attribute,
          cast(count(*) as varchar) as value from orders group by all)
      select actor, {", ".join(f"cast({a} as double) {a}" for a in ATTRIBUTES[:-1])}, not_specified from {_attribute_joins()}""",
    "event_intake": f"""with {MESSAGES}
      select num1, num2, cat1 from msg where event_type in ('click', 'view') order by event_id limit 1500""",
    "event_intake_all": f"""with {MESSAGES}
      select num1, num2, cat1 from msg where event_type in ('click', 'view')""",
    "model_store_every_day": f"with {AGG} select name, type, y, m, d, true model_found, true same from agg",
    "event_model_stream": """select cast(event_id as varchar) guid, true in_range, true same
      from events where event_type in ('click', 'view')""",
    "score_sink_roundtrip": STORED_SCORES,
    "profile_score_table": STORED_SCORES,
    "export_capped_json": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 1000""",
    "adhoc_sql": ADHOC.format(orders="orders", customer="customer"),
    "script_activity_filter": f"""with {WIN} select event_id, windowseventid, windowsprocessname, windowslogontype
      from win where {SCRIPT}""",
    "win_daily_aggregation": f"with {AGG} select * from agg",
    "alert_score_normalised": f"with {AGG}, {_alert_rows()} select * from alrt",
    "alert_score_rescaled": f"with {AGG}, {_alert_rows(True)} select * from alrt",
    "final_anomaly_view": _final(),
    "overall_score_views": f"select name, type, y, m, d, win_total_events, overall_anomaly_score from ({_final()})",
    "final_anomaly_view_by_type": _final("and p.type = t.type"),
    "user_counter_rollup": f"""with {AGG}, spelled as (
        select *, case when d % 2 = 0 then upper(name) else name end username from agg where type = 'user')
      select lower(username) username, {_sum_counters()} from spelled group by lower(username)""",
    "address_counter_rollup": f"""with {AGG} select name ip_src_addr, {_sum_counters()} from agg where type = 'entity' group by name""",
    "mail_profile": """with mail as (
        select source mail_id,
          case doc_id % 4 when 0 then concat(',', cast(n_chars as varchar))
            when 1 then concat(cast(n_chars as varchar), ', ', cast(n_chars + 1 as varchar))
            when 2 then '  ' else cast(n_chars as varchar) end mail_size,
          cast(cast(doc_id % 3 as varchar) as bigint) ext_sndrs from documents),
      kept as (select mail_id, ext_sndrs,
          str_split(replace(case when instr(mail_size, ',') = 1 then list_last(str_split(mail_size, ',')) else mail_size end, ' ', ''), ',') sizes
        from mail where length(trim(mail_size)) > 0),
      per_record as (select mail_id, ext_sndrs, len(sizes) emails,
          coalesce(list_sum(list_transform(sizes, lambda x: try_cast(x as bigint))), 0) bytes from kept)
      select mail_id, cast(sum(emails) as bigint) no_of_emails, cast(sum(bytes) as bigint) tot_email_size,
        cast(sum(ext_sndrs) as bigint) ext_sndrs, round(sum(bytes)::double / sum(emails), 4) avg_email_size
      from per_record group by mail_id""",
    "alert_weight_scores": f"with {MESSAGES} select event_id, alert_score from msg",
    "traffic_bytes_parse": """select l_orderkey, l_linenumber, cast(l_suppkey % 7 as varchar) dst_port,
        cast(1024 + l_linenumber as varchar) src_port,
        case when l_linenumber = 1 then 0 else cast(trunc(l_quantity) as bigint) end rcvd_bytes,
        case when l_linenumber = 2 then 0 else l_partkey end sent_bytes from lineitem""",
    "backfill_dates": """with last as (select user_id, cast(max(ts) as date) last_day from events group by user_id),
      days as (select user_id, cast(last_day - to_days(cast(i as int)) as date) on_day from last, range(7) r(i))
      select user_id, cast(year(on_day) as int) y, cast(month(on_day) as int) m, cast(day(on_day) as int) d,
        strftime(on_day, '%Y-%m-%d') as "day" from days""",
    "profile_windows": " union all ".join(
        _windows(n, s) for n, s in (("hour", 3600), ("day", 86400), ("week", 604800), ("month", 2592000))
    ),
    "profile_windows_stream": f"""with w as ({_windows("day", 86400)})
      select window_start, user_id, events, total_k from w
      where (window_start + 86400) * 1000000 <= (select max(epoch_us(ts)) // 1000 * 1000 - 3600000000 from events)""",
    "ensemble_pas": f"with {SCORES} select name, type, y, m, d, pas_kmeans, pas_isolation, pas_svm, pas from scores",
    "anomaly_label": f"""with {SCORES} select name, type, y, m, d, pas, cast(pas > 60 as int) anomaly, cast(pas > 50 as int) anomaly_50,
        case when pas is null then null when pas <= 30 then 'low' when pas <= 60 then 'medium' else 'high' end as level from scores""",
    "label_split_counts": f"""with {SCORES} select type, cast(pas > 60 as int) anomaly, count(*) as rows from scores group by all""",
    "score_summary": f"""with {SCORES} select type, count(pas) as count, round(avg(pas), 6) mean, round(stddev_samp(pas), 6) stddev,
        min(pas) as min, max(pas) as max from scores group by type""",
    "zscore_profile": f"""with {AGG} select name, type, y, m, d, {", ".join(_zscore(c) for c in COUNTERS)} from agg""",
    "minmax_score": """with r as (select event_type, min(value) low, max(value) high from events group by event_type)
      select event_id, event_type, round((value - low) / (high - low) * 100e0, 6) score from events join r using (event_type)""",
    "missing_model_fallback": f"""with {AGG}, r as (
        select y, m, d, min(total_events) low, max(total_events) high from agg where type = 'user' group by y, m, d)
      select name, type, a.y, a.m, a.d, case when type = 'user' then (case when high = low then 0e0 else
          round((total_events - low)::double / (high - low) * 100e0, 6) end) else 0e0 end pas, type = 'user' model_found
      from agg a left join r on a.y = r.y and a.m = r.m and a.d = r.d""",
    "empty_group_policy": f"""with {AGG} select type, y, m, d, count(*) scored,
        case when max(total_events) = min(total_events) then 0e0 else 100e0 end highest
      from agg where type in ('user', 'entity', 'service') group by type, y, m, d""",
    "sed_frozen_centroids": f"""with {AGG} select name, type, y, m, d, round({SED}, 6) sed,
        round({_clamped(f"({SED})", "5e0", "60e0")}, 6) pas from agg""",
    "iforest_frozen_score": f"""with {AGG} select name, type, y, m, d,
        round(power(2e0, -({FOREST}) / 3e0 / {PATH_256}) - 0.5e0, 6) score from agg""",
    "ocsvm_frozen_score": f"""with {AGG} select name, type, y, m, d,
        round(1.25e0 - (1.5e0 * {_kernel([0, 0, 0, 0, 0, 0])} + 0.5e0 * {_kernel([1, 2, 0, 1, 0, 1])}), 6) score from agg""",
    "string_index": """with r as (select event_type, cast(row_number() over (order by count(*) desc, event_type) - 1 as double) i
        from events group by event_type)
      select event_id, event_type, i event_type_index from events join r using (event_type)""",
    "string_index_of_many": """with e as (select l_orderkey, l_linenumber, cast(cast(round(l_extendedprice * 100) as bigint) as varchar) price from lineitem),
      r as (select price, cast(row_number() over (order by count(*) desc, price) - 1 as double) price_index from e group by price)
      select l_orderkey, l_linenumber, price_index from e join r using (price)""",
    "onehot_standardise": """with r as (select event_type, row_number() over (order by count(*) desc, event_type) - 1 i
        from events group by event_type), f as (select avg(value) a, stddev_samp(value) s, stddev_pop(value) p from events)
      select event_id, cast(i = 0 as int) slot0, cast(i = 1 as int) slot1, cast(i = 2 as int) slot2, cast(i = 3 as int) slot3,
        cast(i = 4 as int) slot4, round((value - a) / s, 6) z_sample, round((value - a) / p, 6) z_population
      from events join r using (event_type), f""",
    "interaction_features": f"""with {AGG} select name, type, y, m, d, logins_count * pri_count logins_count_x_pri_count,
        logins_count * ps_count logins_count_x_ps_count, pri_count * ps_count pri_count_x_ps_count from agg""",
    "quantile_bins": f"""with e as (select event_id, value, {K} k from events),
      q as (select quantile_cont(value, [0.25, 0.5, 0.75]) qv, quantile_cont(k, [0.25, 0.5, 0.75]) qk from e)
      select event_id, cast((value >= qv[1])::int + (value >= qv[2])::int + (value >= qv[3])::int as int) value_bin,
        cast((k >= qk[1])::int + (k >= qk[2])::int + (k >= qk[3])::int as int) k_bin from e, q""",
    "box_stats": """with q as (select event_type, quantile_cont(value, [0.25, 0.5, 0.75]) q from events group by event_type),
      f as (select event_type, q[1] q1, q[2] median, q[3] q3, q[1] - 1.5 * (q[3] - q[1]) lo, q[3] + 1.5 * (q[3] - q[1]) hi from q)
      select event_type, round(any_value(q1), 6) q1, round(any_value(median), 6) median, round(any_value(q3), 6) q3,
        round(min(value) filter (where value between lo and hi), 6) whisker_low,
        round(max(value) filter (where value between lo and hi), 6) whisker_high,
        count(*) filter (where not (value between lo and hi)) outliers
      from events join f using (event_type) group by event_type""",
    "histogram_bins": """with r as (select min(value) lo, (max(value) - min(value)) / 20e0 w, count(*) n from events),
      b as (select cast(least(floor((value - lo) / w), 19) as int) bin, count(*) c from events, r group by 1)
      select cast(i as int) bin, coalesce(c, 0) as count, round(lo + i * w, 6) bin_start, round(lo + (i + 1) * w, 6) bin_end,
        round(coalesce(c, 0) / (n * w), 6) density from range(20) t(i) left join b on b.bin = t.i, r""",
    "normal_density": """with f as (select avg(value) a, stddev_pop(value) s from events)
      select event_id, round(exp(-0.5e0 * power((value - a) / s, 2)) / (s * sqrt(2e0 * pi())), 9) density from events, f""",
    "density_histogram": """with r as (select event_type, min(value) lo, (max(value) - min(value)) / 10e0 w, count(*) n from events group by event_type),
      b as (select event_type, cast(least(floor((value - lo) / w), 9) as int) bin, count(*) c from events join r using (event_type) group by all),
      every as (select event_type, lo, w, n, cast(i as int) bin from r, range(10) t(i))
      select event_type, bin, coalesce(c, 0) as count, round(lo + bin * w, 6) bin_start, round(lo + (bin + 1) * w, 6) bin_end,
        round(coalesce(c, 0) / (n * w), 6) density from every left join b using (event_type, bin)""",
    "onehot_drop_last": """with r as (select event_type, row_number() over (order by count(*) desc, event_type) - 1 i from events group by event_type)
      select event_id, cast((select count(*) from r) - 1 as int) slots, cast(i = 0 as int) slot0, cast(i = 1 as int) slot1,
        cast(i = 2 as int) slot2, cast(i = 3 as int) slot3 from events join r using (event_type)""",
    "cluster_ids": f"""with {AGG}, near as (select type, {", ".join(f"{_squared(c)} d{k}" for k, c in enumerate(CENTRES))} from agg)
      select distinct type, case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end cluster_id from near""",
    "label_coordinates": f"""with {SCORES} select name, type, y, m, d, {", ".join(COUNTERS)}, cast(pas > 60 as int) anomaly
      from scores where pas is not null""",
    "event_alert_table": EVENT_SCORES,
    "event_batch_scoring": EVENT_SCORES,
    "event_stream_scoring": EVENT_SCORES,
    "event_stream_batches": EVENT_SCORES,
    "model_store_roundtrip": f"with {AGG} select name, type, y, m, d, true as same from agg",
    "request_routing": """select c_custkey request_id, case when c_custkey % 5 <> 0 then 'os_log' else 'other_log' end source,
        case when c_custkey % 2 = 0 then 'entity' when c_custkey % 3 <> 0 then 'user' end as type,
        case when c_custkey % 2 = 0 then concat('10.0.0.', cast(c_custkey % 40 as varchar))
             when c_custkey % 3 <> 0 then concat('host', cast(c_custkey % 150 as varchar)) end as name from customer""",
}
