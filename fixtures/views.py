"""The test tables in the roles of raw issue-tracker tables.

Each view is one query that Spark and DuckDB both understand, over whole test
tables. Ids, values and authors come from the event columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession

from fieldtrail.sources.tables import LazyTables

TEST_TABLES = ["region", "nation", "supplier", "part", "events", "conversations", "orders", "lineitem"]

#: The "now" of all queries.
AS_OF = "2024-02-05 00:00:00"

_V = "cast(floor(value) as bigint)"

RAW_VIEWS: dict[str, str] = {
    "issue": f"""
        select user_id as id, user_id % 17 = 16 as _deleted, max(ts) as _synced,
            cast(sum({_V}) as double) as _original_estimate,
            case when user_id % 2 = 0 then cast(2 * sum({_V}) as double) end as original_estimate,
            cast(sum({_V} % 10) as double) as _remaining_estimate,
            cast(null as double) as remaining_estimate,
            case when user_id % 3 = 1 then cast(count(*) as double) end as time_spent,
            cast(count(*) * 60 as double) as _time_spent,
            case when user_id % 7 = 0 then null when user_id % 12 >= 10 then concat('gone-', user_id % 12)
                else cast(user_id % 12 as string) end as assignee,
            min(ts) as created, max(ts) as updated, max(ts) as status_category_changed,
            case when user_id % 3 = 0 then max(ts) end as resolved,
            cast(user_id % 10 as string) as creator, concat('About ', user_id) as description,
            cast(max(ts) as date) as due_date, concat('env ', user_id % 3) as environment,
            user_id % 4 as issue_type, case when user_id % 9 = 0 then 3 end as work_type,
            concat('KEY-', user_id) as key,
            case when user_id % 4 = 1 then user_id - 1 end as parent_id,
            user_id % 5 + 1 as priority, user_id % 25 as project,
            cast((user_id + 3) % 10 as string) as reporter,
            case when user_id % 3 = 0 then 0 end as resolution, user_id % 5 as status,
            concat('Issue ', user_id) as summary, cast(user_id % 101 as double) as work_ratio
        from events group by user_id""",
    "issue_field_history": f"""
        select case event_type when 'view' then 'status'
                when 'click' then case when event_id % 4 = 1 then 'project' else 'customfield_team' end
                when 'signup' then case when event_id % 4 = 1 then 'customfield_quarter' else 'assignee' end
                else case event_id % 5 when 0 then 'resolutiondate' when 1 then 'customfield_epic'
                    when 2 then 'customfield_points' else 'components' end end as field_id,
            user_id as issue_id, ts as time, ts as _synced, true as is_active,
            cast(event_id % 10 as string) as author_id,
            case event_type
                when 'view' then case when {_V} % 13 = 12 then null when {_V} % 11 = 10 then '7'
                    else cast({_V} % 5 as string) end
                when 'click' then cast({_V} % 27 as string)
                when 'signup' then case when event_id % 4 = 1 then cast({_V} % 6 as string)
                    when {_V} % 7 = 0 then null when {_V} % 12 >= 10 then concat('gone-', {_V} % 12)
                    else cast({_V} % 12 as string) end
                else case event_id % 5 when 0 then cast(ts as string)
                    when 1 then case when {_V} % 8 = 7 then null else cast({_V} % 15 as string) end
                    when 2 then case {_V} % 5 when 0 then '' when 1 then 'n/a' when 2 then '1,234.5'
                        when 3 then concat('about ', {_V}) else cast({_V} as string) end
                    else cast({_V} % 25 as string) end end as value
        from events where event_type <> 'purchase'""",
    "issue_multiselect_history": f"""
        select concat('a', event_id) as _row_id, ts as time, ts as _synced, 'customfield_sprint' as field_id,
            user_id as issue_id, true as is_active, cast(event_id % 10 as string) as author_id,
            case when {_V} % 11 = 10 then null else cast({_V} % 25 as string) end as value
        from events where event_type = 'purchase'
        union all
        select concat('b', event_id), ts, ts, 'customfield_sprint', user_id, true,
            cast(event_id % 10 as string), cast({_V} % 25 + 1 as string)
        from events where event_type = 'purchase' and event_id % 2 = 0
        union all
        select concat('c', event_id), ts, ts, case when event_id % 4 = 0 then 'fixVersions' else 'versions' end,
            user_id, true, cast(event_id % 10 as string),
            case when {_V} % 10 = 9 then 'next' else cast({_V} % 9 as string) end
        from events where event_type = 'purchase'
        union all
        select concat('d', event_id), ts, ts, case when event_id % 4 = 0 then 'fixVersions' else 'versions' end,
            user_id, true, cast(event_id % 10 as string), cast({_V} % 7 as string)
        from events where event_type = 'purchase'""",
    # The names that the definitions of the tables ask for; all else comes from the test tables.
    "field": """
        select id, case id when 'status' then 'Status' when 'customfield_team' then 'Team'
                when 'assignee' then 'Assignee' when 'project' then 'Project' when 'components' then 'Components'
                when 'customfield_quarter' then 'Quarter' when 'customfield_points' then 'Story Points'
                when 'customfield_epic' then 'Epic Link' when 'customfield_sprint' then 'Sprint'
                when 'resolutiondate' then 'Resolved' when 'fixVersions' then 'Fix versions'
                else 'Affects versions' end as name,
            id in ('customfield_sprint', 'fixVersions', 'versions') as is_array, id like 'customfield%' as is_custom
        from (
            select case event_type when 'view' then 'status'
                when 'click' then case when event_id % 4 = 1 then 'project' else 'customfield_team' end
                when 'signup' then case when event_id % 4 = 1 then 'customfield_quarter' else 'assignee' end
                when 'purchase' then case event_id % 4 when 0 then 'fixVersions' when 1 then 'versions'
                    else 'customfield_sprint' end
                else case event_id % 5 when 0 then 'resolutiondate' when 1 then 'customfield_epic'
                    when 2 then 'customfield_points' else 'components' end end as id
            from events group by 1
        ) as t""",
    "field_option": "select p_size % 4 as id, min(p_brand) as name from part group by p_size % 4",
    "status": """
        select r_regionkey as id, r_name as name, concat('Status ', r_name) as description,
            r_regionkey % 3 as status_category_id
        from region""",
    "status_category": """
        select r_regionkey % 3 as id,
            case r_regionkey % 3 when 0 then 'To Do' when 1 then 'In Progress' else 'Done' end as name
        from region group by r_regionkey % 3""",
    "issue_type": """
        select p_size % 4 as id, case when p_size % 4 = 0 then 'Epic' else max(p_type) end as name,
            p_size % 4 = 3 as subtask
        from part group by p_size % 4""",
    "priority": """
        select cast(substring(o_orderpriority, 1, 1) as bigint) as id, substring(o_orderpriority, 3) as name
        from orders group by o_orderpriority""",
    "resolution": """
        select row_number() over (order by l_returnflag) - 1 as id, l_returnflag as name,
            concat('Returned ', l_returnflag, ', last ', max(l_linestatus)) as description
        from lineitem group by l_returnflag""",
    "project": """
        select n_nationkey as id, n_name as name, concat('P', n_nationkey) as key,
            cast(n_nationkey % 10 as string) as lead_id, concat('Project ', n_name) as description,
            n_regionkey as project_category_id
        from nation""",
    "team": """
        select cast(n_nationkey as string) as id, concat('Team ', n_name) as name, n_name as title,
            n_nationkey % 2 = 0 as is_shared, true as is_visible
        from nation""",
    "component": """
        select p_partkey as id, p_name as name, p_type as description, p_partkey % 25 as project_id from part""",
    "version": """
        select p_partkey as id, concat(p_brand, '.', p_partkey) as name, p_type as description,
            p_partkey % 25 as project_id, p_size > 25 as archived, p_size > 10 as released,
            date '2024-01-01' + cast(p_size as int) as release_date, date '2024-01-01' as start_date
        from part""",
    "user": """
        select cast(s_suppkey as string) as id, s_name as name, concat('user', s_suppkey, '@example.org') as email,
            concat('u', s_suppkey) as username, 'en' as locale, concat('UTC+', s_nationkey % 3) as time_zone,
            s_acctbal > 0 as is_active
        from supplier""",
    "sprint": """
        select n_nationkey as id, concat('Sprint ', n_nationkey % 20) as name, n_regionkey as board_id,
            n_nationkey % 7 = 6 as _deleted,
            case when n_nationkey <> 23 then
                cast(date '2024-01-01' + cast(n_nationkey % 7 * 4 as int) as timestamp) end as start_date,
            case when n_nationkey <> 24 then
                cast(date '2024-01-11' + cast(n_nationkey % 7 * 4 as int) as timestamp) end as end_date,
            case when n_nationkey % 7 < 4 then
                cast(date '2024-01-12' + cast(n_nationkey % 7 * 4 as int) as timestamp) end as complete_date
        from nation""",
    "comment": """
        select conv_id * 1000 + turn as id, conv_id as issue_id, text as body, role = 'user' as is_public,
            case when turn % 10 = 9 then 'gone-9' else cast(turn % 10 as string) end as author_id,
            cast(turn % 10 as string) as update_author_id,
            timestamp '2024-01-01 00:00:00' + interval '1' hour * turn as created,
            timestamp '2024-01-02 00:00:00' + interval '1' hour * turn as updated
        from conversations""",
    "issue_link": """
        select l_orderkey as issue_id, l_partkey as related_issue_id,
            case l_returnflag when 'A' then 'blocks' when 'N' then 'relates to' else 'duplicates' end as relationship
        from lineitem""",
}

#: "Now" for the order views.
ORDER_AS_OF = "2002-01-01 00:00:00"

#: A large tracker: orders as issues, their lines as changes.
ORDER_VIEWS: dict[str, str] = {
    **RAW_VIEWS,
    "issue": """
        select o_orderkey as id, false as _deleted, o_orderdate as _synced, o_orderdate as created,
            o_orderdate as updated, o_orderdate as resolved, cast(o_custkey % 12 as string) as assignee,
            concat('ORD-', o_orderkey) as key, o_orderpriority as summary, o_custkey % 25 as project,
            o_orderkey % 4 as issue_type, o_orderkey % 5 as status, cast(o_custkey % 10 as string) as reporter,
            cast(o_custkey % 10 as string) as creator, o_orderpriority as description,
            cast(o_orderdate as date) as due_date, o_orderstatus as environment,
            cast(null as bigint) as work_type, cast(null as bigint) as parent_id, o_orderkey % 5 + 1 as priority,
            0 as resolution, o_orderdate as status_category_changed, cast(null as double) as work_ratio,
            cast(floor(o_totalprice) as double) as original_estimate, cast(null as double) as _original_estimate,
            cast(null as double) as remaining_estimate, cast(null as double) as _remaining_estimate,
            cast(null as double) as time_spent, cast(o_custkey as double) as _time_spent
        from orders""",
    "issue_field_history": """
        select case l_linenumber % 3 when 0 then 'customfield_team' when 1 then 'status' else 'project' end as field_id,
            l_orderkey as issue_id, l_shipdate + interval '1' second * l_linenumber as time, l_shipdate as _synced,
            true as is_active, cast(l_suppkey % 10 as string) as author_id,
            case when l_linenumber % 3 = 1 then cast(l_partkey % 5 as string)
                else cast(l_suppkey % 25 as string) end as value
        from lineitem""",
    "issue_multiselect_history": """
        select concat('a', l_orderkey, '-', l_linenumber) as _row_id, l_shipdate as _synced,
            l_shipdate + interval '1' second * l_linenumber as time,
            case when l_linenumber % 4 = 3 then 'fixVersions' else 'customfield_sprint' end as field_id,
            l_orderkey as issue_id, true as is_active, cast(l_suppkey % 10 as string) as author_id,
            cast(l_partkey % 25 as string) as value
        from lineitem""",
}


def source_tables(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    return LazyTables({t: partial(spark.read.parquet, f"{folder}/{t}.parquet") for t in TEST_TABLES})


def spark_view(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a view's SQL with the test tables as parameters."""
    words = sql.split()
    used = {w for i, w in enumerate(words) if w in tables and words[i - 1] == "from"}
    text = " ".join(f"{{{w}}}" if w in used and words[i - 1] == "from" else w for i, w in enumerate(words))
    return spark.sql(text, **{t: tables[t] for t in used})


@cache
def _views(spark: SparkSession, folder: str, orders: bool) -> Mapping[str, DataFrame]:
    tables = source_tables(spark, folder)
    views = ORDER_VIEWS if orders else RAW_VIEWS
    return LazyTables({name: partial(spark_view, spark, sql, tables) for name, sql in views.items()})


def raw_tables(spark: SparkSession, folder: str, *, orders: bool = False) -> Mapping[str, DataFrame]:
    """The raw tables as plans over the test tables, each made when first asked for."""
    # A session of the tests or the driver; the library itself only checks the zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _views(spark, folder, orders)
