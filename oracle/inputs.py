"""The four inputs as DuckDB views over the driver's tables (see FIXTURES.md)."""

INTERACTIONS = """
interactions as (
  select event_id as row_id,
    epoch_us(ts) // 1000 - 1704067200000 as timestamp,
    user_id,
    cast(json_extract_string(props, '$.k') as bigint) as content_id,
    case when event_type = 'signup' then 1 else 0 end as content_type_id,
    cast(hour(ts) as bigint) as task_container_id,
    case when event_type = 'signup' then -1
         when event_type in ('click', 'purchase') then 1 else 0 end as answered_correctly,
    case when value >= 2 then value * 1000 end as prior_question_elapsed_time,
    case when value >= 1 then minute(ts) % 3 = 0 end as prior_question_had_explanation
  from events)"""

QUESTIONS = """
questions as (
  select p_partkey + 5 as question_id,
    cast(substring(p_brand, 7) as bigint) as bundle_id,
    p_size % 7 + 1 as part,
    case when p_size % 10 <> 0 then
      concat_ws(' ', cast((p_partkey * 37) % 188 as varchar),
                cast((p_partkey * 11 + p_size) % 188 as varchar),
                cast(p_size * 3 as varchar)) end as tags
  from part)"""

LECTURES = """
lectures as (
  select p_partkey + 5 as lecture_id, p_size as tag, p_size % 7 + 1 as part,
    case p_partkey % 4 when 0 then 'concept' when 1 then 'intention'
      when 2 then 'solving question' else 'starter' end as type_of
  from part)"""

COMMUNITIES = """
communities as (
  select p_partkey + 5 as question_id, cast(p_partkey % 5 as int) as community
  from part where p_type <> 'ECONOMY')"""
