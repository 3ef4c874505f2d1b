"""DuckDB statements that give the same rows as the registered queries, written without their block design."""

from __future__ import annotations

from dialoom.functions.evaluation import TASK_DESCRIPTION
from dialoom.functions.settings import DEFAULT_SETTINGS, FLOAT_SETTINGS

NL = "chr(10)"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def quoted(text: str | None) -> str:
    if text is None:
        return "cast(null as varchar)"
    return " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in text.split("\n"))


def strip(sql: str) -> str:
    return f"trim({sql}, {BLANKS})"


# name: (statement, tables it uses)
TABLES: dict[str, tuple[str, list[str]]] = {}

TABLES["fx_pairs"] = (
    """select conv_id, turn, text as "user", next_text as assistant from (
  select conv_id, turn, role, text, lead(role) over (partition by conv_id order by turn) as next_role,
         lead(text) over (partition by conv_id order by turn) as next_text
  from conversations) t
where role = 'user' and next_role = 'assistant'""",
    [],
)

TABLES["fx_tagged"] = (
    """select conv_id, turn,
  case turn % 8
    when 1 then '<reasoning>' || substr(text, 1, 20) || '</reasoning>' || chr(10) || '<output>' || substr(text, 21) || '</output>'
    when 3 then 'pre <reasoning>' || text
    when 5 then '<output>' || substr(text, 1, 30) || '</output> tail'
    else text end as text
from conversations where role = 'assistant'""",
    [],
)


def chunks_of(source: str) -> str:
    return f"""select cast(c.conv_id as varchar) || '-' || cast(c.turn as varchar) as rid, cast(s.seq as bigint) as seq,
  substr(c.text, cast(s.seq * 40 + 1 as bigint), 40) as chunk, (s.seq + 1) * 40 >= length(c.text) as is_last
from {source} c, lateral (select unnest(range(0, cast(greatest(ceil(length(c.text) / 40.0), 1) as bigint))) as seq) s"""


TABLES["fx_answers"] = ("select conv_id, turn, text from conversations where role = 'assistant'", [])
TABLES["fx_chunks"] = (chunks_of("fx_answers"), ["fx_answers"])

TABLES["fx_fam"] = (
    f"""select * from (values
  (0, 'phi-4', '<|im_start|>system<|im_sep|>', '<|im_start|>user<|im_sep|>', '<|im_end|>', '<|im_start|>assistant<|im_sep|>', '<|im_end|>'),
  (1, 'llama-3.1', '<|start_header_id|>system<|end_header_id|>' || {NL} || {NL}, '<|start_header_id|>user<|end_header_id|>' || {NL} || {NL}, '<|eot_id|>', '<|start_header_id|>assistant<|end_header_id|>' || {NL} || {NL}, '<|eot_id|>'),
  (2, 'mistral', null, '[INST] ', '[/INST]', ' ', '</s>'),
  (3, 'qwen-2.5', '<|im_start|>system' || {NL}, '<|im_start|>user' || {NL}, '<|im_end|>' || {NL}, '<|im_start|>assistant' || {NL}, '<|im_end|>' || {NL}),
  (4, 'gemma-3', null, '<start_of_turn>user' || {NL}, '<end_of_turn>' || {NL}, '<start_of_turn>model' || {NL}, '<end_of_turn>' || {NL})
) t(f, family, sopen, uopen, uclose, aopen, aclose)""",
    [],
)

TABLES["fx_turn_text"] = (
    """select c.conv_id, c.turn, c.role, c.text, f.*,
  case when c.role = 'assistant' then f.aopen || c.text || f.aclose
       when c.role = 'system' and f.sopen is not null then f.sopen || c.text || f.uclose
       when f.sopen is null and u.user_turn is not null and c.turn = s.sys_turn then null
       when f.sopen is null and s.sys_text is not null and c.turn = u.user_turn
         then f.uopen || s.sys_text || chr(10) || chr(10) || c.text || f.uclose
       else f.uopen || c.text || f.uclose end as rendered
from conversations c join fx_fam f on f.f = c.conv_id % 5
left join (select conv_id, min(turn) as sys_turn, arg_min(text, turn) as sys_text from conversations
           where role = 'system' group by conv_id) s on s.conv_id = c.conv_id
left join (select conv_id, min(turn) as user_turn from conversations where role = 'user' group by conv_id) u
  on u.conv_id = c.conv_id""",
    ["fx_fam"],
)

TABLES["fx_rendered"] = (
    """select conv_id, any_value(family) as model_family, string_agg(rendered, '' order by turn) as text
from fx_turn_text where rendered is not null group by conv_id""",
    ["fx_turn_text"],
)

TABLES["fx_raw"] = (
    """select conv_id, model_family, text || case conv_id % 3 when 1 then chr(10) when 2 then ' ' else '' end as text
from fx_rendered""",
    ["fx_rendered"],
)

_PATTERNS = {
    "phi-4": r"(?s)^.*<\|im_start\|>assistant<\|im_sep\|>(.*?)<\|im_end\|>\n?$",
    "llama-3.1": r"(?s)^.*<\|start_header_id\|>assistant<\|end_header_id\|>\n\n(.*?)<\|eot_id\|>\n?$",
    "mistral": r"(?s)\[/INST\]\s*(.*?)</s>\n?$",
    "qwen-2.5": r"(?s)^.*<\|im_start\|>assistant\n(.*?)<\|im_end\|>\n?$",
    "gemma-3": r"(?s)^.*<start_of_turn>model\n(.*?)\n?$",
}
_CLEAN = {
    **_PATTERNS,
    "mistral": r"(?s)^.*\[/INST\]\s*(.*?)</s>\n?$",
    "gemma-3": r"(?s)^.*<start_of_turn>model\n(.*?)(?:<end_of_turn>)?\s*$",
}


def _extract(patterns: dict[str, str]) -> str:
    lines = [
        f"when model_family = '{name}' and regexp_matches(text, '{p}') then {strip(f'''regexp_extract(text, '{p}', 1)''')}"
        for name, p in patterns.items()
    ]
    return "case " + "\n       ".join(lines) + " end"


TABLES["fx_extracted"] = (
    f"""select conv_id, model_family, {_extract(_PATTERNS)} as answer,
  {_extract(_CLEAN)} as clean_answer from fx_raw""",
    ["fx_raw"],
)

TABLES["fx_samples"] = (
    """select 'm' || cast(o_custkey % 3 as varchar) as model, v.variant, 'arith' as task, o_orderkey as doc_id,
  cast(v.repeat_no as bigint) as repeat_no,
  'Order ' || cast(o_orderkey as varchar) || ' belongs to customer ' || cast(o_custkey as varchar) || '. What is the sum?' as question,
  'Add them. #### ' || cast(o_orderkey + o_custkey as varchar) as answer,
  case (o_orderkey + v.k) % 6
    when 0 then '<reasoning>1 + 2</reasoning><output>' || cast(o_orderkey + o_custkey as varchar) || '</output>'
    when 1 then '<reasoning>x</reasoning>' || chr(10) || '<output> ' || cast(o_orderkey + o_custkey as varchar) || '. </output>'
    when 2 then '<output>' || cast(o_orderkey + o_custkey + 1 as varchar) || '</output>'
    when 3 then 'I think 12 then $' || cast(o_orderkey + o_custkey as varchar) || '.'
    when 4 then 'no idea'
    else '<output>' || cast(o_orderkey + o_custkey as varchar) || '</output>Question: 99' end as response
from orders cross join (
  select 'base' as variant, 0 as repeat_no, 0 as k union all select 'base', 1, 3 union all
  select 'fine_tune', 0, 1 union all select 'fine_tune', 1, 4) v""",
    [],
)

_STOPS = r"Question:|</s>|<\|im_end\|>|<\|eot_id\|>|<end_of_turn>|<\|endoftext\|>"
_STRICT = r"<output>\s*(-?[0-9.,]+)\s*</output>"
_FLEXIBLE = r"-?[$0-9.,]{2,}|-?[0-9]+"


def _cut(sql: str) -> str:
    return f"regexp_replace({sql}, '(?s)(?:{_STOPS}).*$', '')"


def _normal(sql: str) -> str:
    for pattern in (r"(?s)</?reasoning>.*?</reasoning>", "</?output>", r"\n|\r\n|\r", ",", r"\$", r"\.$"):
        sql = f"regexp_replace({sql}, '{pattern}', '', 'g')"
    return f"lower({sql})"


def _strict(sql: str) -> str:
    return f"nullif(regexp_extract({sql}, '{_STRICT}', 1), '')"


def _flexible(sql: str) -> str:
    return f"list_extract(regexp_extract_all({sql}, '{_FLEXIBLE}'), -1)"


_TARGET = (
    "'<reasoning>' || " + strip("string_split(answer, '#### ')[1]") + " || '</reasoning>' || chr(10) || '<output>' || "
    + strip("string_split(answer, '#### ')[2]") + " || '</output>' || chr(10)"
)


def _right(prediction: str) -> str:
    return f"coalesce({_normal(prediction)} = {_normal(_TARGET)}, false)"


TABLES["fx_scored"] = (
    f"""select *, {_right(_strict(_cut('response')))} as strict_right, {_right(_flexible(_cut('response')))} as flexible_right
from fx_samples""",
    ["fx_samples"],
)
TABLES["fx_first"] = (
    """select model, variant, task, doc_id, arg_min(response, repeat_no) as response, arg_min(answer, repeat_no) as answer,
  arg_min(flexible_right, repeat_no) as flexible_right
from fx_scored group by all""",
    ["fx_scored"],
)
TABLES["fx_flips"] = (
    """select model, task, coalesce(b.flexible_right, false) as b, coalesce(t.flexible_right, false) as t
from (select * from fx_first where variant = 'base') b
full outer join (select * from fx_first where variant = 'fine_tune') t using (model, task, doc_id)""",
    ["fx_first"],
)

TABLES["fx_choices"] = (
    """select o_orderpriority as subject, o_orderkey as doc_id, o_orderkey % 7 as s0, o_custkey % 7 as s1,
  (o_orderkey + o_custkey) % 7 as s2, (o_orderkey * 3) % 7 as s3, o_custkey % 4 as answer_idx
from orders""",
    [],
)

TABLES["fx_chatlog"] = (
    """select user_id, event_id, ts,
  case when event_id % 997 = 996 then '/exit'
    when event_id % 13 = 0 then '/temperature'
    when event_id % 17 = 0 then '/help'
    when event_type = 'signup' then '/new'
    when event_type = 'purchase' then '/system Be brief ' || cast(event_id % 7 as varchar)
    when event_type = 'error' then '/temp ' || cast(cast(value - 20 as decimal(10,2)) as varchar)
    when event_type = 'view' then ''
    else 'msg ' || cast(event_id as varchar) || ' ' || chr(92) end as input
from events""",
    [],
)
TABLES["fx_parsed"] = (
    f"""select user_id, event_id, ts, line,
  case when line in ('/exit', '/new', '/clear', '/help') then substr(line, 2)
       when line like '/temp%' then 'temp' when line like '/system%' then 'system'
       when line = '' then 'blank' else 'message' end as kind,
  nullif({strip("case when line like '/temp%' then substr(line, 6) when line like '/system%' then substr(line, 8) end")}, '') as argument
from (select user_id, event_id, ts, {strip("rtrim(input, chr(92))")} as line from fx_chatlog) l""",
    ["fx_chatlog"],
)
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TABLES["fx_temperature"] = (
    f"""select user_id, event_id, case when v > 0 and v < 'infinity'::double then v end as temperature from (
  select user_id, event_id, case when regexp_matches(argument, '{_NUMBER}') then try_cast(argument as double) end as v
  from fx_parsed where kind = 'temp') t""",
    ["fx_parsed"],
)
TABLES["fx_live"] = (
    """select * from (
  select p.*, t.temperature,
    coalesce(sum(case when kind = 'exit' then 1 else 0 end) over (partition by p.user_id order by ts, p.event_id
      rows between unbounded preceding and 1 preceding), 0) as exits_before,
    cast(sum(case when kind = 'new' then 1 else 0 end) over (partition by p.user_id order by ts, p.event_id) as bigint) as conversation,
    coalesce(last_value(case when kind = 'system' then argument end ignore nulls) over (partition by p.user_id order by ts, p.event_id),
      'You are a helpful assistant.') as system_message,
    coalesce(last_value(t.temperature ignore nulls) over (partition by p.user_id order by ts, p.event_id), 0.8::double) as temperature_now
  from fx_parsed p left join fx_temperature t on t.event_id = p.event_id and t.user_id = p.user_id) r
where exits_before = 0""",
    ["fx_parsed", "fx_temperature"],
)
TABLES["fx_messages"] = (
    """select user_id, conversation, row_number() over (partition by user_id, conversation order by ts, event_id) - 1 as message_no,
  event_id, line as text, system_message, temperature_now as temperature
from fx_live where kind = 'message'""",
    ["fx_live"],
)

TABLES["fx_talk"] = (
    f"""select user_id, conversation, event_id, role, line as text, system_message, temperature_now as temperature,
  row_number() over (partition by user_id, conversation order by ts, event_id, role desc) - 1 as message_no from (
  select user_id, conversation, ts, event_id, 'user' as role, line, system_message, temperature_now from fx_live where kind = 'message'
  union all select user_id, conversation, ts, event_id, 'assistant', {strip("'About ' || line")}, system_message, temperature_now
  from fx_live where kind = 'message' and event_id % 5 > 1) t""",
    ["fx_live"],
)

_FAMILY_NAME = (
    "case p_partkey % 7 % 5 when 0 then 'phi-4' when 1 then 'llama-3.1' when 2 then 'mistral' when 3 then 'qwen-2.5' else 'gemma-3' end"
)
TABLES["fx_configs"] = (
    """select p_partkey as k, case p_partkey % 4
    when 0 then 'configs/llama-3.1-8b-' || p_partkey || '.yaml'
    when 1 then 'configs/run ' || p_partkey || '/'
    when 2 then 'team.a/' || p_brand || '-' || p_partkey || '.v2.yml'
    else 'configs/.hidden' || p_partkey end as config from part""",
    [],
)
TABLES["fx_own"] = (
    f"""select p_partkey as k, 'model_name' as setting, 'org/model-' || p_partkey as val from part
union all select p_partkey, 'model_family', case when p_partkey % 7 = 5 then 'none' else {_FAMILY_NAME} end from part where p_partkey % 7 <> 6
union all select p_partkey, 'label', 'Model ' || p_partkey from part where p_partkey % 2 = 0
union all select p_partkey, 'learning_rate', '1e-4' from part where p_partkey % 3 = 0
union all select p_partkey, 'learning_rate', null from part where p_partkey % 3 = 1
union all select p_partkey, 'system_message', null from part where p_partkey % 5 = 0
union all select p_partkey, 'system_message', '' from part where p_partkey % 5 = 1
union all select p_partkey, 'attn_implementation', 'flash' from part where p_partkey % 4 = 0
union all select p_partkey, 'attn_implementation', null from part where p_partkey % 4 = 1
union all select p_partkey, 'format_with_eos_token', 'true' from part where p_partkey % 6 = 0
union all select p_partkey, 'warmup_steps', '5' from part where p_partkey % 9 = 0
union all select p_partkey, 'output_dir', 'runs/' || p_partkey from part where p_partkey % 11 = 0""",
    [],
)
TABLES["fx_defaults"] = (
    "select * from (values " + ", ".join(f"('{k}', {quoted(v)})" for k, v in DEFAULT_SETTINGS.items()) + ") d(setting, val)",
    [],
)
TABLES["fx_merged"] = (
    """select k, setting, val from fx_own
union all select p.p_partkey, d.setting, d.val from part p cross join fx_defaults d
where not exists (select 1 from fx_own o where o.k = p.p_partkey and o.setting = d.setting)""",
    ["fx_own", "fx_defaults"],
)
TABLES["fx_family_of_config"] = (
    """select c.k, c.config, o.val as model_family from fx_configs c
left join fx_own o on o.k = c.k and o.setting = 'model_family'""",
    ["fx_configs", "fx_own"],
)
TABLES["fx_settings"] = (
    """select 0 as f, 'phi-4' as model_family, 'eager' as attn_implementation, '<|im_start|>user<|im_sep|>' as instruction_part,
  '<|im_start|>assistant<|im_sep|>' as response_part,
  '.*<\\|im_start\\|>assistant<\\|im_sep\\|>([\\s\\S]*?)<\\|im_end\\|>$' as response_extraction_pattern
union all select 1, 'llama-3.1', 'sdpa', '<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10),
  '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10),
  '.*<\\|start_header_id\\|>assistant<\\|end_header_id\\|>\\n\\n([\\s\\S]*?)<\\|eot_id\\|>$'
union all select 2, 'mistral', 'eager', '<|im_start|>user' || chr(10), '<|im_start|>assistant' || chr(10),
  '\\[/INST\\]\\s*([\\s\\S]*?)</s>$'
union all select 3, 'qwen-2.5', 'sdpa', '<|im_start|>user' || chr(10), '<|im_start|>assistant' || chr(10),
  '.*<\\|im_start\\|>assistant\\n([\\s\\S]*?)<\\|im_end\\|>$'
union all select 4, 'gemma-3', 'eager', '<start_of_turn>user' || chr(10), '<start_of_turn>model' || chr(10),
  '.*<start_of_turn>model\\n([\\s\\S]*?)$'""",
    [],
)

_N = r"cast(len(regexp_extract_all(text, '\S+')) as bigint)"
TABLES["fx_counts"] = (
    f"""select conv_id, turn, {_N} as n, cast(conv_id // 64 as varchar) || '-' || cast(greatest(turn, 0) // 512 as varchar) as shard
from conversations""",
    [],
)


def _pack(source: str, over: str, block: int = 256) -> str:
    return f"""select *, (end_token - n) // {block} as first_block,
  greatest((end_token - n) // {block}, (end_token - 1) // {block}) as last_block
from (select *, cast(sum(n) over ({over} order by conv_id, turn) as bigint) as end_token from {source}) s"""


TABLES["fx_packed"] = (_pack("fx_counts", "partition by shard"), ["fx_counts"])


def _batched(order: str) -> str:
    return f"select *, (row_number() over (partition by shard order by {order}) - 1) // 4 as batch from fx_counts"


TABLES["fx_by_length"] = (_batched("n desc, conv_id, turn"), ["fx_counts"])

TABLES["fx_sft"] = (
    """select conv_id, turn, "user", assistant, '<|im_start|>user' || chr(10) || "user" || '<|im_end|>' || chr(10)
  || '<|im_start|>assistant' || chr(10) || assistant || '<|im_end|>' || chr(10) as text from fx_pairs""",
    ["fx_pairs"],
)
_CONFORMING = (
    r"regexp_matches({0}, '(?s)^\s*<reasoning>.*</reasoning>\s*<output>.*</output>\s*$')"
    r" and len(regexp_extract_all({0}, '</?(?:reasoning|output)>')) = 4"
)
TABLES["fx_measured"] = (
    f"""select conv_id, turn, shard, n, cast(({_CONFORMING.format('assistant')}) as integer) as conforming,
  cast(sum(n) over (partition by shard order by conv_id, turn) as bigint) as end_token,
  (row_number() over (partition by shard order by conv_id, turn) - 1) // 4 as batch
from (select *, {_N} as n, cast(conv_id // 64 as varchar) || '-' || cast(greatest(turn, 0) // 512 as varchar) as shard from fx_sft) s""",
    ["fx_sft"],
)
TABLES["fx_measured_total"] = (
    """select count(*) as samples, sum(n) as tokens, min(n) as shortest, max(n) as longest,
  count(*) filter (n > 64) as over_n, sum(greatest(n - 64, 0)) as lost, sum(conforming) as conforming,
  count(*) filter ((end_token - 1) // 256 > (end_token - n) // 256) as cut,
  (select sum(b) from (select max((end_token - 1) // 256) + 1 as b from fx_measured group by shard)) as blocks,
  (select sum(w) from (select max(n) * count(*) - sum(n) as w from fx_measured group by shard, batch)) as waste
from fx_measured""",
    ["fx_measured"],
)

_BLOCK = r"<reasoning>.*?(?:</reasoning>|\z)|<output>.*?(?:</output>|\z)"
TABLES["fx_split"] = (
    f"""select conv_id, turn,
  case when o > 0 then substr(text, 1, o - 1) else text end as preamble,
  (list_filter(blocks, lambda b: starts_with(b, '<reasoning>')))[1] as r,
  (list_filter(blocks, lambda b: starts_with(b, '<output>')))[1] as o_block,
  case when o > 0 then regexp_replace(substr(text, o), '(?s){_BLOCK}', '', 'g') else '' end as rest
from (select *, regexp_extract_all(text, '(?s){_BLOCK}') as blocks,
        least(coalesce(nullif(instr(text, '<reasoning>'), 0), 2147483647), coalesce(nullif(instr(text, '<output>'), 0), 2147483647)) as o_at,
        case when instr(text, '<reasoning>') + instr(text, '<output>') = 0 then 0 else o_at end as o
      from fx_tagged) t""",
    ["fx_tagged"],
)
TABLES["fx_sections"] = (
    """select conv_id, turn, preamble, regexp_replace(regexp_replace(r, '^<reasoning>', ''), '</reasoning>$', '') as reasoning,
  regexp_replace(regexp_replace(o_block, '^<output>', ''), '</output>$', '') as output, rest from fx_split""",
    ["fx_split"],
)


def with_tables(sql: str, *names: str) -> str:
    """`sql` with the named derived tables, and those they use, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for used in TABLES[name][1]:
            add(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{name} as (\n{TABLES[name][0]})" for name in ordered) + "\n" + sql


ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, *tables: str) -> None:
    ORACLE[name] = with_tables(sql, *tables)


def _message_list(order: str = "turn") -> str:
    return f"string_agg(role || '>' || text, chr(10) order by {order})"


# --- sources and sinks -------------------------------------------------------------------------------------
oracle("read_pairs", 'select "user", assistant from fx_pairs', "fx_pairs")
oracle("read_turns", "select conv_id, turn, role, text from conversations")
_LLAMA = (
    "'<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || \"user\" || '<|eot_id|>' || "
    "'<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || assistant || '<|eot_id|>'"
)
oracle("write_prepared_roundtrip", f"select {_LLAMA} as text from fx_pairs", "fx_pairs")
oracle(
    "versioned_name",
    """select event_id, event_type || '-' || cast(user_id as varchar) || '-' ||
  case when event_id % 3 = 2 then '00' || cast(event_id % 10 as varchar) else strftime(ts, '%Y_%m_%d_%H_%M') end as name
from events""",
)
oracle("samples_roundtrip", "select * from fx_samples", "fx_samples")
oracle("stream_chunks", "select * from fx_chunks", "fx_chunks")

# --- projections and filters -------------------------------------------------------------------------------
oracle(
    "to_chat",
    """select conv_id, turn, 'user>' || "user" || chr(10) || 'assistant>' || assistant as messages from fx_pairs""",
    "fx_pairs",
)
oracle("sft_text", "select text from fx_sft", "fx_sft")
oracle("drop_blank", f"select user_id, event_id, input from fx_chatlog where {strip('input')} <> ''", "fx_chatlog")
oracle("keep_extracted", "select conv_id, answer from fx_extracted where answer is not null and answer <> ''", "fx_extracted")
oracle(
    "family_rejects",
    """select k, config, model_family from fx_family_of_config
where model_family is null or model_family not in (select model_family from fx_settings)""",
    "fx_family_of_config",
    "fx_settings",
)
oracle("first_system", "select conv_id, arg_min(text, turn) as system_message from conversations where role = 'system' group by conv_id")

# --- joins -------------------------------------------------------------------------------------------------
oracle(
    "family_lookup",
    """select c.k, s.model_family, s.attn_implementation, s.instruction_part, s.response_part, s.response_extraction_pattern
from fx_family_of_config c join fx_settings s using (model_family)""",
    "fx_family_of_config",
    "fx_settings",
)
oracle(
    "config_override",
    """select c.k, s.model_family, case when o.k is not null then o.val else s.attn_implementation end as attn_implementation
from fx_family_of_config c join fx_settings s using (model_family)
left join fx_own o on o.k = c.k and o.setting = 'attn_implementation'""",
    "fx_family_of_config",
    "fx_settings",
)
oracle(
    "render_per_config",
    """select p.conv_id, p.turn, c.config, f.uopen || p."user" || f.uclose || f.aopen || p.assistant || f.aclose as text
from fx_pairs p cross join (values ('gemma-4b-it', 'gemma-3'), ('llama-3.1-8b', 'llama-3.1'), ('llama-3.2-3b', 'llama-3.1'),
  ('mistral-7b', 'mistral'), ('phi-4', 'phi-4'), ('qwen-2.5-7b', 'qwen-2.5')) c(config, family)
join fx_fam f on f.family = c.family""",
    "fx_pairs",
    "fx_fam",
)
oracle(
    "pair_runs",
    """select coalesce(b.model, t.model) as model, coalesce(b.task, t.task) as task, coalesce(b.doc_id, t.doc_id) as doc_id,
  coalesce(b.answer, t.answer) as answer, b.response as base_response, t.response as tuned_response
from (select * from fx_first where variant = 'base') b full outer join (select * from fx_first where variant = 'fine_tune') t
  on b.model = t.model and b.task = t.task and b.doc_id = t.doc_id""",
    "fx_first",
)
oracle(
    "missing_system",
    """select conv_id, min(turn) as first_turn from conversations
where conv_id not in (select conv_id from conversations where role = 'system') group by conv_id""",
)
oracle("system_as_of", "select user_id, event_id, conversation, system_message from fx_live where kind = 'message'", "fx_live")

# --- aggregations ------------------------------------------------------------------------------------------
oracle("sample_count", "select count(*) as samples from fx_pairs", "fx_pairs")
oracle(
    "exact_match_mean",
    """select model, variant, task, 'strict-match' as filter, count(*) as n, sum(cast(strict_right as integer)) / count(*) as exact_match
from fx_scored group by all
union all select model, variant, task, 'flexible-extract', count(*), sum(cast(flexible_right as integer)) / count(*)
from fx_scored group by all""",
    "fx_scored",
)
oracle(
    "compare_runs",
    """select model, task, base, fine_tune, fine_tune - base as difference from (
  select model, task,
    sum(cast(flexible_right as integer)) filter (variant = 'base') / count(*) filter (variant = 'base') as base,
    sum(cast(flexible_right as integer)) filter (variant = 'fine_tune') / count(*) filter (variant = 'fine_tune') as fine_tune
  from fx_scored group by all) t""",
    "fx_scored",
)
_FLIPS = """count(*) filter (b and t) as both_right, count(*) filter (b and not t) as only_base,
  count(*) filter (not b and t) as only_tuned, count(*) filter (not b and not t) as neither"""
oracle("flip_counts", f"select model, task, {_FLIPS} from fx_flips group by all", "fx_flips")
oracle("take_first", "select model, variant, task, doc_id, response from fx_first", "fx_first")
oracle(
    "assemble_chunks",
    f"""select rid, string_agg(case when {strip('chunk')} <> '' then chunk else '' end, '' order by seq) as response
from fx_chunks group by rid""",
    "fx_chunks",
)
oracle(
    "collect_chat",
    f"""select conv_id, count(*) as n_messages, {_message_list()} as messages from conversations group by conv_id""",
)
oracle(
    "length_profile",
    f"""select role, count(*) as rows, min(n) as min_n, max(n) as max_n, cast(sum(greatest(n - 40, 0)) as bigint) as tokens_lost,
  round(sum(n) / count(*), 6) as mean_n, round(quantile_cont(n, 0.5), 6) as median_n, round(quantile_cont(n, 0.95), 6) as p95_n,
  round(count(*) filter (n > 40) / count(*), 6) as over_share
from (select role, {_N} as n from conversations) t group by role""",
)
oracle(
    "pack_stats",
    """select cast(sum(rows) as bigint) as sequences, cast(sum(blocks) as bigint) as blocks, cast(sum(tokens) as bigint) as tokens,
  cast(sum(cut) as bigint) as cut_sequences, round(sum(tokens) / (sum(blocks) * 256), 9) as fill_ratio
from (select shard, count(*) as rows, max(last_block) + 1 as blocks, sum(n) as tokens,
        count(*) filter (last_block > first_block) as cut from fx_packed group by shard) s""",
    "fx_packed",
)
oracle(
    "padding_waste",
    """select shard, batch, count(*) as rows, max(n) as width, cast(max(n) * count(*) - sum(n) as bigint) as waste
from fx_by_length group by shard, batch""",
    "fx_by_length",
)
oracle(
    "tag_conformance",
    f"""select count(*) as n, count(*) filter (c) as conforming, count(*) filter (c) / count(*) as share
from (select {_CONFORMING.format('text')} as c from fx_tagged) t""",
    "fx_tagged",
)
oracle(
    "extraction_rate",
    """select model_family, count(*) as n, count(answer) as read, count(answer) / count(*) as rate
from fx_extracted group by model_family""",
    "fx_extracted",
)
_RIGHT_CHOICE = "(list_position([s0, s1, s2, s3], greatest(s0, s1, s2, s3)) - 1) = answer_idx"
oracle(
    "choice_accuracy",
    f"""select subject, count(*) as n, count(*) filter ({_RIGHT_CHOICE}) / count(*) as accuracy from fx_choices group by subject
union all select 'all', count(*), count(*) filter ({_RIGHT_CHOICE}) / count(*) from fx_choices""",
    "fx_choices",
)

# --- windows, order, packing -------------------------------------------------------------------------------
oracle("turn_pairs", "select * from fx_pairs", "fx_pairs")
_SIGNED = """count(*) over w as n_messages, cast(sum(length({message})) over w as bigint) as prompt_chars,
    cast(sum((({turn} + 1) * cast('0x' || substr(md5({message}), 1, 7) as bigint)) % 2147483647) over w as bigint) as signature"""
oracle(
    "prompt_history",
    f"""select conv_id, turn, n_messages, prompt_chars, signature from (
  select conv_id, turn, role, {_SIGNED.format(turn="turn", message="role || '>' || text")}
  from conversations window w as (partition by conv_id order by turn)) t
where role = 'user'""",
)
oracle(
    "prompts_for",
    """select conv_id, max(turn) as turn, string_agg(role || '>' || text, chr(10) order by turn) as prompt
from (select *, max(turn) filter (role = 'user') over (partition by conv_id) as asked from conversations) t
where turn <= asked group by conv_id""",
)
oracle(
    "prompt_spans",
    """select conv_id, turn, n_messages, prompt_chars from (
  select conv_id, turn, role, count(*) over w as n_messages, cast(sum(length(rendered)) over w as bigint) as prompt_chars
  from fx_turn_text where rendered is not null window w as (partition by conv_id order by turn)) t
where role = 'user'""",
    "fx_turn_text",
)
oracle("segment_log", "select user_id, event_id, kind, conversation from fx_live", "fx_live")
oracle(
    "temperature_as_of",
    "select user_id, event_id, conversation, temperature_now as temperature from fx_live where kind = 'message'",
    "fx_live",
)
oracle("pack_wrapped", "select conv_id, turn, n, shard, end_token, first_block, last_block from fx_packed", "fx_packed")
oracle("pack_wrapped_global", _pack("(select conv_id, turn, n from fx_counts) g", ""), "fx_counts")
oracle(
    "response_spans",
    """select conv_id, turn, end_chars - length(aclose) - length(text) as start_pos, end_chars - length(aclose) as end_pos from (
  select *, cast(sum(length(rendered)) over (partition by conv_id order by turn) as bigint) as end_chars
  from fx_turn_text where rendered is not null) t
where role = 'assistant'""",
    "fx_turn_text",
)
oracle(
    "answer_tokens",
    r"""select conv_id, turn, start + ahead as first_token,
  start + case when text = '' then ahead else greatest(begun, ahead) end - 1 as last_token from (
  select *, cast(sum(n) over (partition by conv_id order by turn) as bigint) - n as start from (
    select *, len(regexp_extract_all(rendered, '\S+')) as n,
      len(regexp_extract_all(left(rendered, length(aopen) + 1), '\S+\s')) as ahead,
      len(regexp_extract_all(left(rendered, length(aopen) + length(text)), '\S+')) as begun
    from fx_turn_text where rendered is not null) c) t
where role = 'assistant'""",
    "fx_turn_text",
)
oracle("batch_ids", _batched("conv_id, turn"), "fx_counts")
oracle("length_grouped_batches", "select * from fx_by_length", "fx_by_length")
oracle("length_order", "select conv_id, turn, n, row_number() over (order by n desc, conv_id, turn) - 1 as position from fx_counts", "fx_counts")
oracle(
    "truncate_tokens",
    r"select conv_id, turn, array_to_string(list_slice(regexp_extract_all(text, '\S+'), 1, 16), ' ') as text from conversations",
)

# --- set operations and splits -----------------------------------------------------------------------------
oracle(
    "ensure_system",
    """select conv_id, turn, role, text from conversations
union all select conv_id, min(turn) - 1, 'system', 'You are a helpful assistant.' from conversations
group by conv_id having count(*) filter (role = 'system') = 0""",
)
oracle(
    "replace_system",
    """select conv_id, turn, role, case when role = 'system' and turn = first_system then 'Answer in one line.' else text end as text
from (select *, min(turn) filter (role = 'system') over (partition by conv_id) as first_system from conversations) t
union all select conv_id, min(turn) - 1, 'system', 'Answer in one line.' from conversations
group by conv_id having count(*) filter (role = 'system') = 0""",
)
oracle("union_runs", "select model, variant, task, doc_id, repeat_no, response from fx_samples", "fx_samples")
oracle(
    "holdout_split",
    """select conv_id, turn, bucket, case when bucket < 100 then 'test' else 'train' end as split
from (select conv_id, turn, cast(('0x' || substr(md5(cast(conv_id as varchar)), 1, 8)) as bigint) % 1000 as bucket from conversations) t""",
)

# --- scalar functions --------------------------------------------------------------------------------------
oracle("render_chat", "select conv_id, text from fx_rendered", "fx_rendered")
oracle(
    "generation_prompt",
    "select conv_id, r.text || f.aopen as prompt from fx_rendered r join fx_fam f on f.f = r.conv_id % 5",
    "fx_rendered",
    "fx_fam",
)
oracle("append_eos", "select conv_id, turn, case when turn % 2 = 1 then text || '<|im_end|>' else text end as text from conversations")
oracle("remove_eos", "select conv_id, replace(text, '<|im_end|>', '') as text from fx_raw", "fx_raw")
oracle("extract_response", "select conv_id, model_family, answer, clean_answer from fx_extracted", "fx_extracted")
oracle("split_tags", "select conv_id, turn, preamble, reasoning, output, rest from fx_sections", "fx_sections")
oracle(
    "eval_prompt",
    f"select doc_id, variant, repeat_no, {quoted(TASK_DESCRIPTION)} || 'Question: ' || question || chr(10) || 'Answer:' as prompt from fx_samples",
    "fx_samples",
)
oracle("eval_target", f"select doc_id, variant, repeat_no, {_TARGET} as target from fx_samples", "fx_samples")
oracle("strict_answer", f"select doc_id, variant, repeat_no, {_strict('response')} as answer from fx_samples", "fx_samples")
oracle("flexible_answer", f"select doc_id, variant, repeat_no, {_flexible('response')} as answer from fx_samples", "fx_samples")
oracle(
    "cut_at_stop",
    f"""select doc_id, variant, repeat_no, {_cut('response')} as response,
  nullif(regexp_extract(response, '{_STOPS}'), '') as stop from fx_samples""",
    "fx_samples",
)
oracle("normalise_answer", f"select doc_id, variant, repeat_no, {_normal('response')} as answer from fx_samples", "fx_samples")
oracle("exact_match_rows", "select doc_id, variant, repeat_no, strict_right, flexible_right from fx_scored", "fx_scored")
oracle("parse_command", "select user_id, event_id, kind, argument from fx_parsed", "fx_parsed")
oracle("clean_input", "select user_id, event_id, line from fx_parsed", "fx_parsed")
oracle("parse_temperature", "select user_id, event_id, temperature from fx_temperature", "fx_temperature")
oracle(
    "family_stub",
    r"""select c.k, regexp_replace(c.model_family, '[^A-Za-z0-9_]+', '_', 'g') as family_stub,
  'org_model_' || cast(c.k as varchar) as name_stub from fx_family_of_config c""",
    "fx_family_of_config",
)
oracle(
    "config_base_name",
    """select c.k, b.base_name, coalesce(o.val, 'outputs/' || b.base_name) as output_folder from fx_configs c
join (select p_partkey as k, case p_partkey % 4 when 0 then 'llama-3.1-8b-' || p_partkey when 1 then 'run ' || p_partkey
        when 2 then p_brand || '-' || p_partkey || '.v2' else '.hidden' || p_partkey end as base_name from part) b using (k)
left join fx_own o on o.k = c.k and o.setting = 'output_dir'""",
    "fx_configs",
    "fx_own",
)
oracle("merge_config", "select k, setting, val from fx_merged", "fx_merged")
oracle(
    "cast_config",
    "select k, "
    + ", ".join(f"cast(max(val) filter (setting = '{key}') as double) as {key}" for key in FLOAT_SETTINGS)
    + " from fx_merged group by k",
    "fx_merged",
)
oracle(
    "config_label",
    """select n.k, case when l.k is not null then l.val else n.val end as label from fx_own n
left join fx_own l on l.k = n.k and l.setting = 'label' where n.setting = 'model_name'""",
    "fx_own",
)

# --- streams -----------------------------------------------------------------------------------------------
oracle(
    "stream_prepare",
    """select '<|im_start|>user<|im_sep|>' || "user" || '<|im_end|><|im_start|>assistant<|im_sep|>' || assistant || '<|im_end|>' as text
from fx_pairs""",
    "fx_pairs",
)
ORACLE["stream_assemble"] = ORACLE["assemble_chunks"]
oracle(
    "stream_tags",
    """select cast(conv_id as varchar) || '-' || cast(turn as varchar) as rid, section, text from (
  select conv_id, turn, 'text' as section, preamble || rest as text from fx_sections
  union all select conv_id, turn, 'reasoning', reasoning from fx_sections
  union all select conv_id, turn, 'output', output from fx_sections) t
where text <> ''""",
    "fx_sections",
)
oracle(
    "stream_replay",
    "select user_id, conversation, message_no, event_id, text, system_message, temperature from fx_messages",
    "fx_messages",
)
ORACLE["stream_score"] = ORACLE["exact_match_mean"]

# --- caller's functions ------------------------------------------------------------------------------------
oracle(
    "token_counts",
    rf"""select conv_id, turn, {_N} as n, cast(length(regexp_replace(text, '\s+', '', 'g')) as bigint) as piece_chars, {_N} as n_default
from conversations""",
)
_SUM = "(o_orderkey + o_custkey)"
_GENERATED = f"'<output>' || cast({_SUM} + case when {_SUM} % 5 = 0 then 1 else 0 end as varchar) || '</output>'"
oracle(
    "generate_responses",
    f"""select o_orderkey as doc_id, v.variant, cast(v.repeat_no as bigint) as repeat_no, {_GENERATED} as response
from orders cross join (values ('base', 0), ('base', 1), ('fine_tune', 0), ('fine_tune', 1)) v(variant, repeat_no)""",
)

# --- composite jobs ----------------------------------------------------------------------------------------
oracle(
    "prepare_dataset",
    """select '<start_of_turn>user' || chr(10) || "user" || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10)
  || assistant || '<end_of_turn>' || chr(10) || '<eos>' as text from fx_pairs""",
    "fx_pairs",
)
_METRICS = {
    "samples": "samples",
    "tokens": "tokens",
    "min_tokens": "shortest",
    "max_tokens": "longest",
    "mean_tokens": "tokens / samples",
    "over_limit_share": "over_n / samples",
    "tokens_lost": "lost",
    "tag_conformance": "conforming / samples",
    "extraction_rate": "1",
    "packed_blocks": "blocks",
    "packed_fill_ratio": "tokens / (blocks * 256)",
    "cut_sequences": "cut",
    "padding_waste": "waste",
}
oracle(
    "dataset_metrics",
    " union all ".join(
        f"select '{name}' as metric, round(cast({sql} as double), 9) as value from fx_measured_total" for name, sql in _METRICS.items()
    ),
    "fx_measured_total",
)
oracle(
    "evaluate_runs",
    f"""select 'm' || cast(o_custkey % 3 as varchar) as model, v.variant, 'arith' as task, f.filter, count(*) as n,
  count(*) filter ({_SUM} % 5 <> 0) / count(*) as exact_match
from orders cross join (values ('base'), ('fine_tune')) v(variant)
cross join (values ('strict-match'), ('flexible-extract')) f(filter) group by all""",
)
oracle(
    "compare_all",
    f"""select *, fine_tune - base as difference from (
  select model, task, count(*) as docs, count(*) filter (b) / count(*) as base, count(*) filter (t) / count(*) as fine_tune, {_FLIPS}
  from fx_flips group by all) c""",
    "fx_flips",
)
oracle(
    "replay_log",
    f"""select user_id, conversation, message_no, event_id, system_message, temperature,
  n_messages + 1 as n_messages, prompt_chars + length('system>' || system_message) as prompt_chars, signature from (
  select *, {_SIGNED.format(turn="message_no", message="'user>' || text")}
  from fx_messages window w as (partition by user_id, conversation order by message_no)) t""",
    "fx_messages",
)
oracle(
    "replay_answers",
    f"""select user_id, conversation, message_no, event_id, system_message, temperature,
  n_messages + 1 as n_messages, prompt_chars + length('system>' || system_message) as prompt_chars, signature from (
  select *, {_SIGNED.format(turn="message_no", message="role || '>' || text")}
  from fx_talk window w as (partition by user_id, conversation order by message_no)) t
where role = 'user'""",
    "fx_talk",
)
_LAST = """select user_id, max(conversation) as conversation,
  count(*) filter (kind = 'exit') > 0 as ended, arg_max(system_message, (ts, event_id)) as system_message,
  arg_max(temperature_now, (ts, event_id)) as temperature
from fx_live group by user_id"""
oracle(
    "stream_sessions",
    f"""select l.user_id, l.conversation, count(t.text) as messages,
  cast(coalesce(sum(length(t.role || '>' || t.text)), 0) as bigint) as chars,
  any_value(l.system_message) as system_message, any_value(l.temperature) as temperature, any_value(l.ended) as ended
from ({_LAST}) l left join fx_talk t on t.user_id = l.user_id and t.conversation = l.conversation
group by l.user_id, l.conversation""",
    "fx_live",
    "fx_talk",
)
oracle(
    "stream_history",
    f"""select t.user_id, t.message_no, t.role, t.text
from fx_talk t join ({_LAST}) l on t.user_id = l.user_id and t.conversation = l.conversation""",
    "fx_live",
    "fx_talk",
)

# --- runs, configs, splits and orders ----------------------------------------------------------------------
ORACLE["samples_by_run"] = ORACLE["samples_roundtrip"]
oracle(
    "config_texts",
    """select c.config, count(*) as texts, cast(sum(length(t.text)) as bigint) as chars, max(t.text) as last_text from (
  select c.k, c.config, s.model_family, e.k is not null as ends from fx_configs c join fx_family_of_config s on s.k = c.k
  left join (select k from fx_own where setting = 'format_with_eos_token') e on e.k = c.k) c
join (select f.family, e.ends, f.uopen || p."user" || f.uclose || f.aopen || p.assistant || f.aclose
    || case when e.ends then trim(f.aclose, chr(10)) else '' end as text
  from fx_pairs p cross join fx_fam f cross join (values (true), (false)) e(ends)) t
  on t.family = c.model_family and t.ends = c.ends group by c.config""",
    "fx_configs",
    "fx_family_of_config",
    "fx_own",
    "fx_pairs",
    "fx_fam",
)
_HASH = "cast(('0x' || substr(md5({}), 1, 15)) as bigint)"
oracle(
    "exact_split",
    f"""select c.conv_id, c.turn, case when r <= floor(0.1 * n + 0.5) then 'test' else 'train' end as split
from conversations c join (
  select conv_id, row_number() over (order by h, conv_id) as r, count(*) over () as n
  from (select distinct conv_id, {_HASH.format("cast(conv_id as varchar)")} as h from conversations) k) s using (conv_id)""",
)
oracle(
    "group_by_length",
    f"""select *, position // 4 as batch from (
  select conv_id, turn, n, case when spot = 0 and mega = longest then 0 when spot = 0 and mega = 0 then longest * 40
    else mega * 40 + spot end as position from (
    select *, row_number() over (partition by mega order by n desc, h, conv_id, turn) - 1 as spot,
      first_value(mega) over (order by n desc, mega) as longest from (
      select *, (row_number() over (order by h, conv_id, turn) - 1) // 40 as mega
      from (select conv_id, turn, n, {_HASH.format("'7:' || conv_id || ':' || turn")} as h from fx_counts) d) r) o) p""",
    "fx_counts",
)
oracle(
    "settings_as_of",
    """select m.user_id, m.event_id, s.argument as system_message
from (select * from fx_parsed where kind = 'message') m asof left join (
  select user_id, ts, max(argument) as argument from fx_parsed where kind = 'system' and argument is not null group by all) s
  on m.user_id = s.user_id and m.ts >= s.ts""",
    "fx_parsed",
)
oracle(
    "response_metrics",
    rf"""select model_family, count(*) as responses, count(n) / count(*) as extraction_rate,
  count(*) filter (answer = '') as empty,
  count(*) filter ({_CONFORMING.format('answer')}) as conforming,
  min(n) as min_tokens, quantile_disc(n, 0.5) as median_tokens, quantile_disc(n, 0.95) as p95_tokens, max(n) as max_tokens
from (select *, case when answer <> '' then cast(len(regexp_extract_all(answer, '\S+')) as bigint) end as n from fx_extracted) e
group by model_family""",
    "fx_extracted",
)
oracle(
    "mapped_records",
    r"""select conv_id, turn, cast(len(said) as bigint) as words, cast(len(list_intersect(said, asked)) as bigint) as shared
from (select conv_id, turn, regexp_extract_all("user", '\S+') as asked, regexp_extract_all(assistant, '\S+') as said from fx_pairs) p""",
    "fx_pairs",
)
