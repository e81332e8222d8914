"""Views over the given tables that stand in for recorded trajectories; both engines read the same SQL."""

VIEWS = {
    "tasks_fx": r"""
SELECT conv_id AS task_id, 'p' || CAST(conv_id AS STRING) AS pid,
       min_by(text, turn) AS question,
       CASE WHEN conv_id % 5 = 0 THEN 'list' WHEN conv_id % 5 = 1 THEN ' List ' ELSE 'text' END AS answer_type,
       CASE WHEN conv_id % 4 = 0 THEN '/abs/' || CAST(conv_id AS STRING) || '.png' ELSE 'img/' || CAST(conv_id AS STRING) || '.jpg' END AS image,
       CAST(conv_id % 7 AS STRING) AS gold, conv_id % 6 <> 0 AS first_ok, conv_id % 10 = 3 AS broken
FROM conversations WHERE role = 'user' GROUP BY conv_id
""",
    "turns_fx": r"""
WITH a AS (
  SELECT conv_id AS task_id, turn AS src_turn, text, CAST(conv_id % 7 AS STRING) AS gold,
         ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS turn
  FROM conversations WHERE role = 'assistant')
SELECT task_id, turn, src_turn, gold,
  CASE (task_id * 3 + turn) % 9
    WHEN 0 THEN '<think> ' || text || ' </think><tool_call>{"name":" insert_element ","arguments":{"fragment":"<b id=e1>x</b>","rootId":"root"}}</tool_call>'
    WHEN 1 THEN '<think>' || text || '<tool_call> {"tool":"modify_element","args":{"targetId":"e1","attrs":{"fill":"red"}}} </tool_call>'
    WHEN 2 THEN text || '<tool_call>{"name":"paint","arguments":{}}</tool_call><tool_call>{bad</tool_call><tool_call>{"name":"clear","kwargs":{"x":1}}</tool_call>'
    WHEN 3 THEN '<THINK>' || text || '</THINK><answer> ' || chr(92) || 'boxed{ ' || gold || ' }</answer>'
    WHEN 4 THEN text || '<answer>' || chr(92) || 'boxed{' || CAST(2 * (task_id % 7) AS STRING) || ' / 2}</answer>'
    WHEN 5 THEN text || '<Answer>' || gold || '</Answer>'
    WHEN 6 THEN text || ' /boxed{' || gold || '.0}'
    WHEN 7 THEN text || '<answer>' || chr(92) || 'boxed{9_9}</answer><tool_call>{"name":"remove_element","arguments":{"target":"e1"}}</tool_call>'
    ELSE text END AS assistant_raw,
  CASE (task_id + turn) % 7
    WHEN 0 THEN '{"hallucination_elements":[],"is_consistent":true,"format_ok":true,"is_correct":true,"normalized_answer":"' || gold || '"}'
    WHEN 1 THEN 'note' || chr(10) || '```json' || chr(10) || '{"is_consistent":"yes","is_correct":"no"}' || chr(10) || '```'
    WHEN 2 THEN 'see {"hallucination_elements":[{"category":"Math Error"}],"is_consistent":false}'
    WHEN 3 THEN '{"hallucination_elements":[{"category":"Visual Error","original_fact":"three discs"},{"category":"Logical Error","notebook_claim":"four","explanation":"it has three"}],"is_consistent":false,"is_correct":1}'
    WHEN 4 THEN 'no json'
    WHEN 5 THEN '[1]'
    ELSE '{"is_consistent":true}' END AS critic_raw,
  CASE WHEN task_id % 3 = 0 THEN CAST(NULL AS STRING) ELSE '{"is_consistent":true,"format_ok":true,"is_correct":"' || CASE WHEN turn % 2 = 0 THEN 'yes' ELSE 'no' END || '","normalized_answer":" again "}' END AS critic_again,
  'tool execute failed: code ' || CAST(task_id % 3 AS STRING) AS render_error,
  length(text) AS prompt_tokens, src_turn * 10 AS completion_tokens,
  CASE WHEN turn % 2 = 0 THEN 0 ELSE length(text) + src_turn * 10 + 1 END AS total_tokens,
  (task_id + turn) % 5 <> 0 AS render_ok
FROM a
""",
    "edits_fx": r"""
SELECT user_id AS session_id,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
       CASE event_type WHEN 'click' THEN 'insert_element' WHEN 'view' THEN 'modify_element'
            WHEN 'error' THEN 'remove_element' WHEN 'purchase' THEN 'replace_element' ELSE 'clear' END AS action,
       'e' || CAST(event_id % 5 AS STRING) AS target_id,
       'v' || CAST(event_id % 13 AS STRING) AS fill,
       event_id % 11 <> 0 AS render_ok
FROM events
""",
    "html_fx": r"""
SELECT page_id,
       CASE page_id % 4 WHEN 0 THEN '<div id=a>' || html || '<img title="a>b" src="' || url || '"/></div>'
            WHEN 1 THEN html || '<svg id=s><image x="3" xlink:href="' || url || '"/></svg>'
            WHEN 2 THEN html || '<img src="local/' || CAST(page_id AS STRING) || '.png"/>'
            ELSE html END AS fragment, url, html
FROM pages
""",
    "items_fx": r"""
SELECT conv_id AS pos,
       CASE conv_id % 5
         WHEN 0 THEN '{"question":" ' || replace(replace(min_by(text, turn), chr(10), ' '), '"', ' ') || ' ","answer":[1,"a",true,null],"pid":0,"id":"i' || CAST(conv_id AS STRING) || '","choices":[1,"b",true],"image":"x.png"}'
         WHEN 1 THEN '{"question":"q","answer_type":" LIST ","answer":1.0}'
         WHEN 2 THEN '{"question":null,"answer":null,"choices":{},"pid":' || CAST(conv_id AS STRING) || ',"image":"/x.png"}'
         WHEN 3 THEN '{"answer":" b ","id":"k"}'
         ELSE '{"question":"r","answer":true,"pid":"","image":" y.jpg "}' END AS item_json
FROM conversations GROUP BY conv_id
""",
    "tree_fx": r"""
SELECT session_id, seq, action, render_ok,
       CASE action
         WHEN 'insert_element' THEN '{"fragment":"<g id=' || target_id || '><rect fill=' || fill || '></rect></g>","rootId":"root"}'
         WHEN 'modify_element' THEN '{"targetId":"' || target_id || '","attrs":{"fill":"' || fill || '"}}'
         WHEN 'remove_element' THEN '{"targetId":"' || target_id || '"}'
         WHEN 'replace_element' THEN '{"targetId":"' || target_id || '","fragment":"<g id=' || target_id || '><b>' || fill || '</b></g>"}'
         ELSE '{}' END AS args_json
FROM edits_fx
""",
    "body_fx": r"""
SELECT session_id, seq, action, render_ok,
       CASE action
         WHEN 'insert_element' THEN '{"fragment":"<g id=' || target_id || '><rect fill=' || fill || '></rect></g>","rootId":""}'
         WHEN 'modify_element' THEN '{"targetId":"' || target_id || '","attrs":{"fill":"' || fill || '"}}'
         WHEN 'remove_element' THEN '{"targetId":"' || target_id || '"}'
         WHEN 'replace_element' THEN '{"targetId":"' || target_id || '","fragment":"<g id=' || target_id || '><b>' || fill || '</b></g>"}'
         ELSE '{}' END AS args_json
FROM edits_fx
""",
}
