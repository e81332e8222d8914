import json

import duckdb
import pytest
from pyspark.sql import functions as F

from waymark.functions.parse import parse_response
from waymark.functions.text import equivalent_answer
from waymark.jobs import registry
from waymark.operators import canvas, judge, tools, trajectory
from waymark.sources import tasks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("conversations", "events", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.execute(registry.oracle_sql()[name])
    at = [[d[0] for d in want.description].index(c) for c in cols]
    assert sorted(tuple(map(str, r)) for r in df.select(*cols).collect()) == sorted(tuple(str(r[i]) for i in at) for r in want.fetchall())


def test_equivalent_answers(spark):
    rows = [(" A B ", "ab", True), ("1/2", "0.5", True), ("-3/4", "-0.75", True), ("1_000", "1000", True), ("1,000", "1000", False), ("50%", "0.5", False), ("1d", "1", False), ("1.5/2", "0.75", False), ("1/0", "inf", False), ("nan", "nan", True), ("inf", "infinity", False), ("", "", False), ("1", "1.0000000001", True), (None, "1", False)]
    df = spark.createDataFrame(rows, "m string, g string, want boolean")
    assert df.where(equivalent_answer(F.col("m"), F.col("g")) != F.col("want")).count() == 0


def test_parsing(spark):
    texts = ['<think>a<tool_call>{"name":"clear"}</tool_call>', "<THINK>a<tool_call>{}</tool_call>", r"<answer>\boxed{\frac{1}{2}}</answer>", r"<answer>\boxed{1} and {2}</answer>", r"<answer>7</answer> \boxed{7}", r"<answer>\boxed{3}", '<tool_call>{"tool":"clear","args":"{}"}</tool_call>', '<tool_call>{"name":"clear","arguments":null,"args":{}}</tool_call>', '<tool_call>{"name":"clear"} x</tool_call>', "<think>x</think>", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, assistant_raw string")
    r = [x for x in parse_response(df).orderBy("i").collect()]
    assert (r[0].reasoning, [c.name for c in r[0].tool_calls]) == ("a", ["clear"]) and r[0].seed_content.startswith("<tool_call>")
    assert (r[1].reasoning, r[1].malformed) == ("", 1)
    assert [x.boxed for x in r[2:6]] == [r"\frac{1}{2}", "1} and {2", "", "3"] and r[5].has_answer_tag and r[5].answer == ""
    assert [len(x.tool_calls) for x in r[6:9]] == [1, 0, 0] and [x.malformed for x in r[7:9]] == [1, 1]
    assert (r[9].content, r[9].seed_content) == ("", "x") and r[10].content == ""


def test_json_objects_and_truth():
    assert judge.object_in('{"a":1}') == {"a": 1} and judge.object_in("[1]") == {} and judge.object_in("none") == {}
    assert judge.object_in('```json\n{"a":1}\n``` and ```{"b":2}```') == {"b": 2}
    assert judge.object_in('see {"a":[{"b":1}],"c":2}') == {"b": 1}
    assert [judge.truth(v, "d") for v in (True, " Yes ", "n", 1, None, "maybe")] == [True, True, False, "d", "d", "d"]


def test_fenced_blocks_end_with_a_brace():
    assert list(judge.fenced('```json {"a":"``` x"} ``` ```JSON\n{"b":{}}\n``` ```{"c"')) == ['{"a":"``` x"}', '{"b":{}}']
    assert judge.object_in('``` text ``` ```{"a":1}```') == {"a": 1}


def test_tool_validation(spark):
    raws = ['{"name":" paint ","arguments":{}}', '{"name":"insert_element","arguments":{}}', '{"name":"clear","arguments":{"x":1}}', '{"name":"remove_element","arguments":{"targetId":null}}']
    df = spark.createDataFrame([(i, "p", 1, f"<tool_call>{t}</tool_call>", False, "") for i, t in enumerate(raws)], "task_id long, pid string, turn int, assistant_raw string, render_ok boolean, first_render string")
    rows = tools.call_rows(tools.with_calls(parse_response(df))).orderBy("task_id").collect()
    assert [r.invalid for r in rows] == ["invalid tool name: paint", "missing args for insert_element: fragment, rootId", "clear arguments must be {}", ""]
    assert rows[3].result == "Error: render failed. Reverted to previous successful state."


def test_task_files_of_three_shapes(spark, tmp_path):
    item = {"question": "q", "answer": [1, "a", True, None], "choices": ["x", 2.0], "image": "i.png", "id": 7}
    shapes = [[item, 3, {"question": None}], {"data": [item, "x", {"question": None}]}, {"10": {"question": None}, "2": item, "a": {"question": ""}, "z": 1}]
    for n, shape in enumerate(shapes):
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(shape))
        got = tasks.load_tasks(spark, str(path), 0, 10, "/r").orderBy("task_id").collect()
        assert [(r.task_id, r.pid, r.question, r.image_path) for r in got] == [(0, "7", "q", "/r/i.png"), (1, "sample_1", "None", "/r/")]
        assert got[0].answers == ['[1, "a", true, null]', "1", "a", "True", "None"] and got[0].instruction == "q\nChoices:\nA. x\nB. 2.0"
    (tmp_path / "none.json").write_text("3")
    assert tasks.read_tasks(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(ValueError):
        tasks.load_tasks(spark, "x", 3, 3)


def test_shuffling_is_a_permutation_that_depends_on_the_seed_alone(spark):
    df = spark.range(1000).withColumnRenamed("id", "task_id")
    order = lambda d, seed: [r.task_id for r in tasks.shuffled(d, seed).orderBy("order").collect()]
    first = order(df, 1)
    assert sorted(first) == list(range(1000)) and first == order(df.repartition(7), 1) and first != order(df, 2)


def test_written_examples_come_back(spark, tmp_path):
    log = spark.createDataFrame([(1, 0, 0, 0, 0, "user", [("text", "hi", None)], False), (1, 1, 1, 1, 0, "assistant", [("text", "yo", None)], False)], "task_id long, pos int, turn int, kind int, call int, role string, parts array<struct<type:string,text:string,url:string>>, shown boolean")
    done = spark.createDataFrame([(1, "p", 1.0)], "task_id long, pid string, reward double")
    tasks.write_sft_turns(trajectory.sft_turns(log, done), str(tmp_path / "sft"))
    assert [(r.task_id, r.pid, r.turn, r.prompt[0].parts[0].text, r.completion, r.reward) for r in spark.read.json(str(tmp_path / "sft")).collect()] == [(1, "p", 1, "hi", "yo", 1.0)]


def test_turns_without_a_render(spark):
    """With a critic none is accepted; a verdict without the fields is unusable."""
    rows = [(1, True, True, "{}"), (2, True, False, "{}"), (3, True, False, '{"is_correct":true,"normalized_answer":"n"}'), (4, False, True, "{}")]
    df = spark.createDataFrame([(*r, "c", False) for r in rows], "task_id int, base_ok boolean, local_ok boolean, critic_raw string, candidate string, rendered boolean")
    got = judge.judge(df, "critic_raw", "rendered").orderBy("task_id").collect()
    assert [(r.format_ok, r.is_correct, r.normalized, r.critique, r.accepted) for r in got] == [(True, True, "c", "", False), (True, False, "c", "", False), (True, True, "n", "", False), (False, False, "c", "", False)]
    assert got[1].feedback == judge.UNUSABLE and got[0].feedback == judge.INCONSISTENT
    assert [r.accepted for r in judge.judge(df, None, "rendered").orderBy("task_id").collect()] == [True, False, False, False]


def test_choices_labels(spark):
    text = spark.createDataFrame([([str(i) for i in range(28)],)], "c array<string>").select(tasks.choices_text(F.col("c"))).first()[0]
    assert text.split("\n")[1] == "A. 0" and text.split("\n")[-2:] == ["C27. 26", "C28. 27"]


def test_canvas_against_a_plain_fold(spark):
    edits = registry.view(spark, SF, "edits_fx")
    held = {}
    for e in sorted(edits.collect(), key=lambda e: (e.session_id, e.seq)):
        els = held.setdefault(e.session_id, [])
        if not e.render_ok:
            continue
        first = next((x for x in els if x[0] == e.target_id), None)
        if e.action == "clear":
            els.clear()
        elif e.action == "insert_element":
            els.append([e.target_id, e.fill])
        elif first and e.action == "remove_element":
            els.remove(first)
        elif first:
            first[1] = e.fill
    want = sorted((s, t, f, i + 1) for s, els in held.items() for i, (t, f) in enumerate(els))
    assert sorted((r.session_id, r.target_id, r.fill, r.pos) for r in canvas.replay_flat(edits).collect()) == want


def test_notebook_trees():
    c = canvas.Canvas("<figure id='base_figure'><img id='base_image' src='data:x'/></figure>", False)
    c.apply("insert_element", {"fragment": "<svg><rect id=r x=1></rect><image href='http://a/b' y=2></svg>", "rootId": "root"})
    c.apply("insert_element", {"fragment": "<p>hi<br>you", "rootId": "gone"})
    c.apply("insert_element", {"fragment": "<b id=q>1</b>", "rootId": "", "beforeId": "r"})
    c.apply("modify_element", {"targetId": "r", "attrs": {"x": True, "text": 5}})
    c.apply("modify_element", {"targetId": "nobody", "attrs": {"x": 1}})
    c.apply("unknown", {})
    rows = [(r[1], r[2], r[3], json.loads(r[4]), r[5]) for r in c.rows()]
    assert [r[:3] for r in rows] == [(None, "div", "root"), (0, "figure", "base_figure"), (1, "img", "base_image"), (0, "svg", "initial_svg"), (3, "b", "q"), (3, "rect", "r"), (3, "text", ""), (None, "p", "elem_13"), (7, "br", "")]
    assert rows[5][3:] == ({"id": "r", "x": "True"}, "5") and rows[6][3:] == ({"x": "0", "y": "2", "fill": "#ED2633"}, "[blocked external svg image]") and rows[7][4] == "hiyou"
    c.apply("replace_element", {"targetId": "r", "fragment": "<i src=http://x>"})
    c.apply("remove_element", {"targetId": "root"})
    assert [r[2] for r in c.rows()] == ["p", "br"]
    c.apply("insert_element", {"fragment": "<img src='https://e.x/i.png'>", "rootId": "root"})
    assert [(r[2], r[5]) for r in c.rows()][2:] == [("div", ""), ("div", "[blocked external image] https://e.x/i.png")]
    c.apply("clear", {})
    assert [r[2] for r in c.rows()] == ["div", "figure", "img"]
    open_ = canvas.Canvas(None, True)
    open_.apply("insert_element", {"fragment": "<img id=i src='https://e.x/i.png'>", "rootId": "root"})
    assert [r[2] for r in open_.rows()] == ["div", "img"]


def test_trees_of_sessions_in_spark(spark):
    edits = [(1, 1, "insert_element", '{"fragment":"<p id=a>x</p>","rootId":"root"}', True), (1, 2, "clear", "{}", True), (1, 3, "insert_element", '{"fragment":"<p id=b>y</p>","rootId":"root"}', True), (1, 4, "remove_element", '{"targetId":"b"}', False), (2, 1, "insert_element", '{"fragment":"<p id=c>z</p>","rootId":"root"}', False)]
    df = spark.createDataFrame(edits, "session_id long, seq long, action string, args_json string, render_ok boolean")
    bases = spark.createDataFrame([(2, "data:q"), (3, "")], "session_id long, image_url string")
    got = {(r.session_id, r.pos): r.element_id for r in canvas.replay_tree(df, bases).collect()}
    assert got == {(1, 0): "root", (1, 1): "b", (2, 0): "root", (2, 1): "base_figure", (2, 2): "base_image", (3, 0): "root"}
    assert canvas.replay_tree(df.limit(0)).collect() == []
    below = spark.createDataFrame([(1, i, "insert_element", '{"fragment":"<p id=e%d><b></b></p>","rootId":""}' % i, True) for i in range(1, 6)], df.schema)
    assert sorted(r.element_id for r in canvas.body_children(canvas.replay_tree(below)).collect()) == ["e3", "e4", "e5"]


def test_sessions_are_dealt_to_tasks_and_have_one_base(spark):
    """Few bytes of edits are much work: Spark's own choice of partitions by bytes left all sessions to one task. A base that comes twice doubles no edit."""
    edits = [(s, q, "insert_element", '{"fragment":"<p id=a>x</p>","rootId":"root"}', True) for s in range(64) for q in (1, 2)]
    df = spark.createDataFrame(edits, "session_id long, seq long, action string, args_json string, render_ok boolean")
    twice = spark.createDataFrame([(s, "data:q") for s in range(64)] * 2, "session_id long, image_url string")
    state = canvas.replay_state(df.where("seq = 1"), twice)
    for folded in (state, canvas.replay_history(df), canvas.resumed(state.cache(), df.where("seq = 2"))):
        assert folded.select(F.spark_partition_id()).distinct().count() > 1
    assert canvas.replay_tree(df, twice).count() == 64 * 5
    assert canvas.replay_tree(df).count() == 64 * 3


def test_sessions_stay_whole_where_spark_merges_partitions(spark):
    """Spark takes a union of tables dealt by session as dealt, and merges the partitions of each by bytes: a session's base and edits came apart."""
    told = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    was = {k: spark.conf.get(k, None) for k in told}
    fragment = F.concat(F.lit('{"fragment":"<p id=a>'), F.md5(F.col("id").cast("string")), F.lit('</p>","rootId":"root"}'))
    df = spark.range(5000).select((F.col("id") % 1000).alias("session_id"), (F.col("id") / 1000 + 1).cast("long").alias("seq"), F.lit("insert_element").alias("action"), fragment.alias("args_json"), F.lit(True).alias("render_ok"))
    try:
        for k, v in told.items():
            spark.conf.set(k, v)
        made = [canvas.replay_tree(df).collect(), canvas.tree_of(canvas.resumed(canvas.replay_state(df.where("seq < 3")), df)).collect()]
        histories = canvas.replay_history(df).count()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [(len(rows), len({(r.session_id, r.pos) for r in rows})) for rows in made] == [(6000, 6000)] * 2
    assert histories == 1000


def test_blocked_images_keep_the_rest():
    html = '<div id=a>x &lt; <img alt="a>b" src="https://e.x/i?a=1&amp;b=2"/></div><img src=local.png>'
    assert canvas.sanitized(html) == '<div id="a">x &lt; <div style="color:#ED2633;font-size:14px;padding:8px 0;word-break:break-word;">[blocked external image] https://e.x/i?a=1&amp;b=2</div></div><img src="local.png"/>'
    assert canvas.sanitized(None) is None


def test_malformed_edits_leave_no_trace(spark):
    """Attributes that are no object, null and broken arguments: the session goes on as if they were not there."""
    good = ('{"fragment":"<p id=a>x</p>","rootId":"root"}', '{"targetId":"a","attrs":{"fill":"red"}}')
    edits = [(1, 1, "insert_element", good[0]), (1, 2, "modify_element", '{"targetId":"a","attrs":"red"}'), (1, 3, "modify_element", '{"targetId":"a","attrs":["x"]}'), (1, 4, "modify_element", None), (1, 5, "insert_element", "{"), (1, 6, "remove_element", "[]"), (1, 7, "clear", "3"), (1, 8, "modify_element", good[1]), (2, 1, "clear", None)]
    df = spark.createDataFrame([(*e, True) for e in edits], "session_id long, seq long, action string, args_json string, render_ok boolean")
    kept = df.where("seq in (1, 8) or session_id = 2")
    for replayed in (canvas.replay_tree, lambda e: canvas.tree_at(canvas.element_versions(canvas.replay_history(e)), 99).drop("from_seq", "to_seq", "node", "rank")):
        assert sorted(map(str, replayed(df.where("action <> 'clear'")).collect())) == sorted(map(str, replayed(kept.where("action <> 'clear'")).collect()))
    assert [r.element_id for r in canvas.replay_tree(df.where("session_id = 2")).collect()] == ["root"]
    assert sorted({r.seq for r in canvas.views_by_edit(canvas.replay_history(df.where("session_id = 1"))).collect()}) == [1, 8]


def test_comments_scripts_and_doctypes_stay():
    html = "<!DOCTYPE html><!-- a < b --><style>p > a { x: 'y' }</style><script>if (a < b && c) { f(\"<p>\") }</script><p>1 &lt; 2</p>"
    assert canvas.sanitized(html) == html
    own = canvas.Canvas(None, False)
    own.apply("insert_element", {"fragment": "<div id=d>x<!-- note --><script>a < b</script>y</div>", "rootId": "root"})
    assert own.rows()[1][5] == "xy" and own.rows()[2][5] == "a < b"
    assert canvas.markup(canvas.Canvas.stored([dict(zip(("pos", "parent", "tag", "element_id", "attrs", "text", "children", "last_seq", "base"), r)) for r in own.state(3)], False).body) == canvas.markup(own.body)


def random_edits(rng, n):
    ids = [f"e{i}" for i in range(5)] + ["root"]
    for _ in range(n):
        name, where, before = rng.choice(ids), rng.choice([*ids, ""]), rng.choice([None, None, *ids])
        fragment = rng.choice([f"<g id={name}>t<b>u</b>v<!--c--></g>", f"<g id={name}><i id={rng.choice(ids)}></i></g>", "<p>no id</p>", f"<br id={name}>", "only text"])
        action = rng.choice(["insert_element"] * 5 + ["modify_element", "modify_element", "remove_element", "replace_element", "replace_element", "clear", "clear_element", "unknown"])
        args = {"fragment": fragment, "rootId": where, "beforeId": before, "targetId": name, "attrs": rng.choice([{"x": 1}, {"text": "new <b>"}, {"text": "w", "y": None}, {}, "bad"])}
        yield action, json.dumps({} if action == "clear" else args), rng.random() > 0.1


def test_histories_and_snapshots_equal_replays(spark):
    """Random edits, with and without a base: at every edit the versions are the tree of a replay up to it, and views its last three; trees go on from stored ones."""
    import random

    rng = random.Random(5)
    edits = [(s, i + 1, *e) for s in range(4) for i, e in enumerate(random_edits(rng, 40))]
    df = spark.createDataFrame(edits, "session_id long, seq long, action string, args_json string, render_ok boolean")
    bases = spark.createDataFrame([(0, "data:a"), (1, ""), (7, "data:b")], "session_id long, image_url string")
    history = canvas.replay_history(df, bases).cache()
    versions, views = canvas.element_versions(history).collect(), canvas.views_by_edit(history).collect()
    base = {0: "<figure id='base_figure'><img id='base_image' src='data:a'/></figure>"}
    for s in range(4):
        own = canvas.Canvas(base.get(s), False)
        for seq, (action, args, ok) in enumerate([e[2:] for e in edits if e[0] == s], 1):
            if not ok or not own.try_apply(action, args):
                continue
            stand = [v for v in versions if v.session_id == s and v.from_seq <= seq and (v.to_seq is None or v.to_seq > seq)]
            below = {}
            for v in sorted(stand, key=lambda v: v.rank):
                below.setdefault(v.parent, []).append(v)
            flat = lambda at: [x for v in below.get(at, []) for x in ((v.tag, v.element_id, v.attrs, v.text), *flat(v.node))]  # noqa: B023, E731
            assert flat(None) == [r[2:6] for r in own.rows()]
            shown = [c.attrs.get("id", "") for c in own.body.children if isinstance(c, canvas.Node)][-3:]
            assert [v.element_id for v in sorted((v for v in views if (v.session_id, v.seq) == (s, seq)), key=lambda v: v.place)] == shown
    whole = sorted(map(str, canvas.replay_tree(df, bases).collect()))
    state = canvas.replay_state(df.where("seq <= 13"), bases)
    for low, high in ((13, 25), (25, 26), (25, 26), (26, 40)):
        state = spark.createDataFrame(canvas.resumed(state, df.where(f"seq > {low} and seq <= {high}")).collect(), state.schema)
    assert sorted(map(str, canvas.tree_of(state).collect())) == whole
    assert canvas.resumed(state, df.limit(0)).count() == state.count()


def test_batches_of_any_id_count_once(spark, tmp_path):
    from waymark.sources.batches import BatchTable

    table = BatchTable(spark, str(tmp_path / "t"), "x long")
    ids = ["a/b", "a b/c", "__HIVE_DEFAULT_PARTITION__", "", "..", "k=1", "é\n", "1", "01", "1e3", "_x", "a" * 500]
    for i, name in enumerate(ids):
        assert table.append(name, spark.range(i, i + 1).toDF("x")) and not table.append(name, spark.range(99).toDF("x"))
    assert sorted(r.x for r in table.read().collect()) == list(range(len(ids))) and [r.x for r in table.read("a/b").collect()] == [0]
    spark.range(5).toDF("x").write.parquet(str(tmp_path / "t/rows/batch=left-by-a-failure"))
    assert table.read().count() == len(ids) and BatchTable(spark, str(tmp_path / "t"), "x long").read().count() == len(ids)


def test_rounds_are_issued_and_answered_once(spark, tmp_path):
    from waymark.operators import rounds

    ledger = rounds.RoundLedger(spark, str(tmp_path / "l"))
    asked = rounds.with_ids(spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (2, 1, "b")], "task_id long, turn int, body string"), "judge")
    first = ledger.issue("step 1", asked)
    assert first.count() == 2 and ledger.issue("step 1", asked.limit(0)).count() == 2
    more = rounds.with_ids(spark.createDataFrame([(2, 1, "b"), (3, 1, "c")], "task_id long, turn int, body string"), "judge")
    assert [r.task_id for r in ledger.issue("step 2", more).collect()] == [3]
    ids = {r.task_id: r.request_id for r in ledger.asked.read().collect()}
    schema = "request_id string, reply string, arrived long"
    assert ledger.record("r/1", spark.createDataFrame([(ids[1], "late", 5), (ids[1], "y", 2), (ids[1], "x", 2), (ids[1], None, 1), ("other", "z", 1)], schema))
    assert not ledger.record("r/1", spark.createDataFrame([(ids[2], "x", 1)], schema))
    assert {r.task_id: (r.reply, r.n_replies) for r in ledger.state().collect()} == {1: ("x", 3), 2: (None, 0), 3: (None, 0)}
    assert sorted(r.task_id for r in ledger.pending().collect()) == [2, 3]


def test_open_tasks(spark):
    kept = spark.createDataFrame([(1, 1, True), (2, 1, False), (3, 1, False), (3, 2, False), (3, 3, False)], "task_id long, turn int, accepted boolean")
    own = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "task_id long")
    from waymark.operators import rounds

    assert sorted(map(tuple, rounds.open_tasks(own, kept, 2, 1).collect())) == [(2, 2), (4, 1)]


def plain_items(p):
    if isinstance(p, dict):
        if isinstance(p.get("data"), list):
            p = p["data"]
        else:
            p = [p[k] for k in sorted(p, key=lambda k: (0, f"{int(k):012d}") if k.isdigit() else (1, k))]
    return [x for x in p if isinstance(x, dict)] if isinstance(p, list) else []


def test_json_files_are_read_in_parts(spark, tmp_path):
    """Random payloads of all shapes, cut into blocks of 300 bytes."""
    import random

    from waymark.sources.json_array import read_objects

    rng = random.Random(2)

    def value(depth=0):
        r = rng.random()
        if depth < 2 and r < 0.3:
            return {rng.choice(["a", "data", "x,y", 'q"]', "\\"]): value(depth + 1) for _ in range(rng.randint(0, 3))}
        if depth < 2 and r < 0.5:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        return rng.choice([1, -2.5, None, True, "", " a,b ", '"]}{[,"', "\\", '\\\\",', "é\n,\t", "x" * rng.randint(0, 40)])

    shapes = [[value() for _ in range(60)], {"z": value(), "data": [value() for _ in range(40)], "w": {"data": [1]}}, {rng.choice([str(i), f"k,{i}", f"00{i}"]): value() for i in range(25)}, {"data": 3, "a": {"b": 1}}, [], {}, 3]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for n, payload in enumerate(shapes):
            (tmp_path / f"{n}.json").write_text(json.dumps(payload, ensure_ascii=n % 2 == 0, indent=(None, 1)[n % 2]))
            got = read_objects(spark, str(tmp_path / f"{n}.json")).orderBy("pos").collect()
            assert [(r.pos, json.loads(r.item_json)) for r in got] == list(enumerate(plain_items(payload)))
        (tmp_path / "open.json").write_text('[{"a":1},{"b":2}')
        with pytest.raises(ValueError):
            read_objects(spark, str(tmp_path / "open.json"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def array_in(folder):
    return json.loads("".join(f.read_text() for f in sorted(folder.glob("part-*"))))


def test_results_are_one_array_in_order(spark, tmp_path):
    """Nested results as they are written: arguments as objects, images by URL, no verdict where none is; tasks that broke have an error alone."""
    whole, kept = registry.log(spark, SF)
    own = registry.tasks(spark, SF)
    own = own.join(tasks.shuffled(own.select("task_id"), 7), "task_id")
    errors = own.select("task_id", F.when(F.col("broken"), "gone").alias("error"), F.lit(0.5).alias("elapsed_sec"))
    out = trajectory.results(own, kept, whole, errors)
    tasks.write_results(out.repartition(3), str(tmp_path / "r"))
    got, want = array_in(tmp_path / "r"), {r.task_id: r for r in out.collect()}
    assert [o["order"] for o in got] == list(range(len(want))) and {o["task_id"] for o in got} == set(want)
    for o in got:
        r = want[o["task_id"]]
        assert ("error" in o) == (r.error is not None) == ("final_answer" not in o) and len(o["turns"]) == len(r.turns)
        for t, u in zip(o["turns"], r.turns):
            assert t["policy_usage"] == {} and ("answer_judge" in t) == (u.answer_judge is not None) and t["critic_feedback"] == u.critic_feedback
            assert [c["arguments"] for c in t["tool_results"]] == [json.loads(c.arguments_json) for c in u.tool_results]
        for m, n in zip(o["messages"], r.messages):
            assert m == {"role": n.role, "content": [{"type": "text", "text": p.text} if p.type == "text" else {"type": "image_url", "image_url": {"url": p.url}} for p in n.parts]}
    tasks.write_results(out.limit(0), str(tmp_path / "none"))
    assert array_in(tmp_path / "none") == []


def test_arrays_take_places_that_are_equal_or_missing(spark, tmp_path):
    from waymark.sources.json_array import write_array

    rows = [(0, '"a"'), (0, '"a"'), (None, '"n"'), (2, '{"x,":"]"}'), (1, "3")]
    write_array(spark.createDataFrame(rows, "order long, text string").repartition(3), str(tmp_path / "a"))
    assert array_in(tmp_path / "a") == ["n", "a", "a", 3, {"x,": "]"}]


def test_an_empty_slice_is_an_error(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"question": " "}, {"question": "q"}]))
    assert tasks.load_tasks(spark, str(tmp_path / "t.json"), 0, 5, "/r").count() == 1
    for start, end in ((0, 1), (5, 9)):
        with pytest.raises(ValueError):
            tasks.load_tasks(spark, str(tmp_path / "t.json"), start, end, "/r")


def test_numbers_of_any_script_and_size(spark):
    from fractions import Fraction

    from waymark.functions.text import parse_numeric

    def plain(t):
        try:
            return float(Fraction(t)) if t.count("/") == 1 else float(t)
        except (ValueError, ArithmeticError):
            return None

    texts = ["90071992547409930/3", "٣/٤", "１２.５", "𝟗", "९९९/٣", "1" * 400, "1" * 400 + "/1", "-7/2", "-1/3", "1/0", "+5/10", "12345678901234567890123/7", "1e400", "-0/5", "1_000/1_0", "0/0", "x", "²", "½", "1.5/2"]
    df = spark.createDataFrame([(t, plain(t)) for t in texts], "t string, want double")
    assert df.where(~parse_numeric(F.col("t")).eqNullSafe(F.col("want"))).collect() == []


def test_images_are_encoded_once(spark, tmp_path):
    store = tasks.ImageStore(spark, str(tmp_path / "s"))
    images = spark.createDataFrame([("a.png", b"1"), ("b.jpg", b"1"), ("c.svg", b"2"), ("d.png", b"")], "path string, content binary")
    store.add("1", images.where("path <> 'c.svg'"))
    known = store.add("2", images, 1)
    assert store.table.read().count() == 3 and store.add("2", images.limit(0)).count() == 0
    assert {r.path: (r.image_url, r.run) for r in store.urls(known).collect()} == {"a.png": ("data:image/png;base64,MQ==", "1"), "b.jpg": ("data:image/jpeg;base64,MQ==", "1"), "c.svg": ("data:image/svg+xml;base64,Mg==", "2"), "d.png": ("data:image/png;base64,", "1")}


def test_rules_of_a_catalogue(spark):
    schemas = [("f", '{"properties":{"a":{"type":["string","null"]},"n":{"type":"number"},"any":{}},"required":["a"],"additionalProperties":false}'), ("none", '{"properties":{},"additionalProperties":false}'), ("free", "{}")]
    calls = [("f", {"a": None, "n": 1, "any": []}, ""), ("f", {"n": 1}, "missing args for f: a"), ("f", {"a": 1, "n": "x"}, "wrong types for f: a, n"), ("f", {"a": "x", "n": True}, "wrong types for f: n"), ("f", {"a": "x", "z": 1, "y": 2}, "unexpected args for f: z, y"), ("none", {"x": 1}, "none arguments must be {}"), ("none", {}, ""), ("free", {"x": 1}, ""), ("g", {}, "invalid tool name: g")]
    rows = [(i, "p", 1, "<tool_call>" + json.dumps({"name": n, "arguments": a}) + "</tool_call>", True, "") for i, (n, a, _) in enumerate(calls)]
    df = spark.createDataFrame(rows, "task_id long, pid string, turn int, assistant_raw string, render_ok boolean, first_render string")
    out = tools.call_rows(tools.with_calls(parse_response(df), catalogue=spark.createDataFrame(schemas, "name string, parameters string"))).orderBy("task_id").collect()
    assert [r.invalid for r in out] == [w for _, _, w in calls]
