"""Notebook replay: flat elements by folding arrays, trees of HTML by folding each session's edits, external images."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def since_clear(edits: DataFrame, clearing: Column) -> DataFrame:
    """Edits after a session's last clear: what came before leaves no trace."""
    cleared = F.max(F.when(clearing, F.col("seq"))).over(Window.partitionBy("session_id"))
    return edits.withColumn("cleared", F.coalesce(cleared, F.lit(0))).where(F.col("seq") > F.col("cleared"))


def effective(edits: DataFrame) -> DataFrame:
    """Edits that left a trace: valid by the catalogue, where that was judged, and rendered."""
    return edits.where(F.col("render_ok") & (F.col("invalid") == "" if "invalid" in edits.columns else F.lit(True)))


def replay_flat(edits: DataFrame) -> DataFrame:
    """session_id, target_id, fill, pos: elements left after the ordered edits that rendered.

    Nothing before a session's last clear matters. An insert adds an element at the end; of several with one id the
    first is the target of the others' edits, so an insert of an id that stands is kept as a twin only until removed.
    """
    live = since_clear(effective(edits), F.col("action") == "clear")
    steps = live.groupBy("session_id", "target_id").agg(F.array_sort(F.collect_list(F.struct("seq", "action", "fill"))).alias("steps"))
    twin = "array<struct<seq:bigint,fill:string>>"
    fold = F.aggregate(
        "steps",
        F.array().cast(twin),
        lambda held, s: F.when(s["action"] == "insert_element", F.concat(held, F.array(F.struct(s["seq"].cast("long").alias("seq"), s["fill"].alias("fill")))).cast(twin))
        .when(F.size(held) == 0, held)
        .when(s["action"] == "remove_element", F.slice(held, F.lit(2), F.size(held)))
        .when(s["action"].isin("modify_element", "replace_element"), F.concat(F.array(F.struct(held[0]["seq"].alias("seq"), s["fill"].alias("fill"))), F.slice(held, F.lit(2), F.size(held))).cast(twin))
        .otherwise(held),
    )
    left = steps.select("session_id", "target_id", F.explode(fold).alias("e")).select("session_id", "target_id", "e.seq", "e.fill")
    return left.select("session_id", "target_id", "fill", F.row_number().over(Window.partitionBy("session_id").orderBy("seq")).alias("pos"))


def viewport(elements: DataFrame, last: int = 3) -> DataFrame:
    return elements.withColumn("back", F.row_number().over(Window.partitionBy("session_id").orderBy(F.desc("pos")))).where(F.col("back") <= last).drop("back")


#: Elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements of the page around the body: html, head, two meta, title, style and body itself.
AROUND = 7


#: Elements whose text is no markup, so that it is not escaped.
RAW_TEXT = {"script", "style"}


class Aside(str):
    """A comment, doctype or instruction as it stands in markup; no text of its element."""


class Node:
    """An element; children are nodes and texts. ever: all elements that were below it, in their order, those taken out since among them."""

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children, self.parent, self.ever = tag, attrs or {}, [], None, []

    def add(self, child, at: int | None = None) -> None:
        follows = next((c for c in self.children[at:] if isinstance(c, Node)), None) if at is not None else None
        self.children.insert(len(self.children) if at is None else at, child)
        if isinstance(child, Node):
            child.parent = self
            self.ever.insert(len(self.ever) if follows is None else next(i for i, c in enumerate(self.ever) if c is follows), child)

    def replace(self, other: Node | None) -> None:
        at = next(i for i, c in enumerate(self.parent.children) if c is self)
        del self.parent.children[at]
        if other is not None:
            self.parent.add(other, at)
        self.parent = None

    def below(self) -> Iterator[Node]:
        """Elements in document order, without recursion, as fragments may be deep."""
        open_ = [c for c in reversed(self.children) if isinstance(c, Node)]
        while open_:
            node = open_.pop()
            yield node
            open_ += [c for c in reversed(node.children) if isinstance(c, Node)]

    def find(self, name) -> Node | None:
        return next((n for n in self.below() if n.attrs.get("id") == name), None)


class Reader(HTMLParser):
    """A tree of HTML. An end tag closes the nearest open element of its name, with all in it; others are passed over."""

    def __init__(self):
        super().__init__()
        self.root = self.open = Node("")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open.add(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.open.add(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        node = self.open
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.open = node.parent

    def handle_data(self, data):
        self.open.add(data)

    def handle_comment(self, data):
        self.open.add(Aside(f"<!--{data}-->"))

    def handle_decl(self, decl):
        self.open.add(Aside(f"<!{decl}>"))

    def handle_pi(self, data):
        self.open.add(Aside(f"<?{data}>"))

    def unknown_decl(self, data):
        self.open.add(Aside(f"<![{data}]>"))


def parsed(fragment: str) -> Node:
    reader = Reader()
    reader.feed(fragment)
    reader.close()
    return reader.root


def markup(node: Node) -> str:
    """A tree as HTML again."""
    out, todo = [], list(reversed(node.children))
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            out.append(x[0])
        elif isinstance(x, str):
            out.append(x if isinstance(x, Aside) else escape(x, quote=False))
        else:
            attrs = "".join(f' {k}="{escape(v)}"' for k, v in x.attrs.items())
            out.append(f"<{x.tag}{attrs}/>" if x.tag in VOID else f"<{x.tag}{attrs}>")
            if x.tag not in VOID:
                inner = [(c,) if x.tag in RAW_TEXT and isinstance(c, str) else c for c in x.children]
                todo += [(f"</{x.tag}>",), *reversed(inner)]
    return "".join(out)


#: What stands for blocked images.
NOTE_STYLE = "color:#ED2633;font-size:14px;padding:8px 0;word-break:break-word;"
NOTE_FILL = "#ED2633"


def external(url: str) -> bool:
    return url.strip().lower().startswith(("http://", "https://"))


def block_images(tree: Node) -> None:
    """External img and svg image elements give way to notes."""
    for node in list(tree.below()):
        source = node.attrs.get("src", "") if node.tag == "img" else (node.attrs.get("href") or node.attrs.get("xlink:href") or "") if node.tag == "image" else ""
        if node.parent is None or not external(source):
            continue
        if node.tag == "img":
            note, words = Node("div", {"style": NOTE_STYLE}), f"[blocked external image] {source}"
        else:
            note, words = Node("text", {"x": node.attrs.get("x") or "0", "y": node.attrs.get("y") or "0", "fill": NOTE_FILL}), "[blocked external svg image]"
        note.add(words)
        node.replace(note)


def sanitized(html: str | None) -> str | None:
    if html is None:
        return None
    tree = parsed(html)
    block_images(tree)
    return markup(tree)


@F.pandas_udf(T.StringType())
def sanitize_udf(html: pd.Series) -> pd.Series:
    return html.map(sanitized)


def sanitize_images(html: Column, allow_external: bool = False) -> Column:
    """External <img> and svg <image> elements give way to notes that name them. Only HTML that can have any is parsed; other HTML stays as it is."""
    return html if allow_external else F.when(html.rlike(r"(?i)<im(?:g|age)\b") & html.rlike(r"(?i)https?://"), sanitize_udf(html)).otherwise(html)


class Canvas:
    """A notebook's body. base: a fragment that stands in it from the start and again after each clear."""

    def __init__(self, base: str | None, allow_external: bool):
        self.body, self.base, self.allow = Node("body"), base, allow_external
        self.reset()

    def reset(self) -> None:
        self.take_out(self.body, list(self.body.children))
        self.put(self.body, Node("div", {"id": "root"}))
        if self.base:
            self.insert({"fragment": self.base, "rootId": "root"})

    def put(self, parent: Node, node: Node, at: int | None = None) -> None:
        parent.add(node, at)

    def take_out(self, parent: Node, children: list) -> None:
        gone = set(map(id, children))
        parent.children = [c for c in parent.children if id(c) not in gone]

    def changed(self, node: Node) -> None:
        """Called after an element's attributes or text have changed."""

    def try_apply(self, action: str, args_json: str | None) -> bool:
        """Whether the edit was applied. One whose arguments are no object or cannot be used leaves no trace."""
        try:
            args = json.loads(args_json)
            if not isinstance(args, dict):
                return False
            self.apply(action, args)
        except (AttributeError, TypeError, ValueError):
            return False
        return True

    def apply(self, action: str, args: dict) -> None:
        """Unknown actions, missing targets and empty arguments change nothing. What can fail is done before anything changes."""
        if action == "insert_element":
            self.insert(args)
        elif action == "modify_element":
            self.modify(args)
        elif action == "remove_element" or action == "replace_element":
            node = self.body.find(args["targetId"]) if args.get("targetId") else None
            new = self.first(args.get("fragment"), False) if action == "replace_element" else None
            if node is not None and (new is not None or action == "remove_element"):
                parent, at = node.parent, next(i for i, c in enumerate(node.parent.children) if c is node)
                if new is not None:
                    self.put(parent, new, at)
                self.take_out(parent, [node])
        elif action in ("clear", "clear_element"):
            self.reset()

    def first(self, fragment, block: bool) -> Node | None:
        if not fragment:
            return None
        tree = parsed(str(fragment))
        if block and not self.allow:
            block_images(tree)
        return next(tree.below(), None)

    def insert(self, args: dict) -> None:
        node = self.first(args.get("fragment"), True)
        if node is None:
            return
        if not node.attrs.get("id"):
            # The names of elements that come without an id.
            node.attrs["id"] = "initial_svg" if node.tag == "svg" else f"elem_{AROUND + sum(1 for _ in self.body.below())}"
        where = args.get("rootId")
        parent = self.body.find(where) if where else self.body
        if parent is None:
            parent = self.body
            if where == "root":
                parent = Node("div", {"id": "root"})
                self.put(self.body, parent)
        before = self.body.find(args["beforeId"]) if args.get("beforeId") else None
        if before is None:
            self.put(parent, node)
        else:
            self.put(before.parent, node, next(i for i, c in enumerate(before.parent.children) if c is before))

    def modify(self, args: dict) -> None:
        target, attrs = args.get("targetId"), args.get("attrs")
        node = self.body.find(target) if target and attrs else None
        given = {k: str(v) for k, v in attrs.items()} if node is not None else {}
        for key, value in given.items():
            if key == "text":
                self.take_out(node, list(node.children))
                node.children = [value]
            else:
                node.attrs[key] = value
        if given:
            self.changed(node)

    def rows(self) -> list[tuple]:
        """pos, parent (its pos; null below the body), tag, element_id, attrs (JSON), text (its own) and children (JSON: texts, and pos of elements) of each element in document order."""
        nodes = list(self.body.below())
        at = {id(n): i for i, n in enumerate(nodes)}
        return [(i, at.get(id(n.parent)), *described(n), pieces(n, at)) for i, n in enumerate(nodes)]

    def state(self, last_seq: int) -> list[tuple]:
        """rows(), each with last_seq and base, and the body itself before them, at -1."""
        nodes = list(self.body.below())
        at = {id(n): i for i, n in enumerate(nodes)}
        return [(*r, last_seq, self.base) for r in ((-1, None, "body", "", "{}", "", pieces(self.body, at)), *self.rows())]

    @classmethod
    def stored(cls, rows: list, allow_external: bool) -> Canvas:
        """The notebook of a state(): rows with pos, tag, attrs, children and base."""
        own = cls(None, allow_external)
        own.body = Node("body")
        made = {r["pos"]: Node(r["tag"], json.loads(r["attrs"])) if r["pos"] >= 0 else own.body for r in rows}
        for r in rows:
            for c in json.loads(r["children"]):
                made[r["pos"]].add(made[c] if isinstance(c, int) else Aside(c[0]) if isinstance(c, list) else c)
        own.base = next(r["base"] for r in rows)
        return own


def described(node: Node) -> tuple[str, str, str, str]:
    return node.tag, node.attrs.get("id", ""), json.dumps(node.attrs, ensure_ascii=False), "".join(c for c in node.children if isinstance(c, str) and not isinstance(c, Aside))


def pieces(node: Node, at: dict[int, int]) -> str:
    return json.dumps([at[id(c)] if isinstance(c, Node) else [c] if isinstance(c, Aside) else c for c in node.children], ensure_ascii=False)


class History(Canvas):
    """A notebook that keeps all its versions: each element with the edits between which it stood as it is, and what a render shows after each edit."""

    def __init__(self, base: str | None, allow_external: bool, last: int):
        self.seq, self.last, self.serial, self.open, self.closed, self.views = 0, last, {}, {}, [], []
        super().__init__(base, allow_external)

    def begin(self, node: Node) -> None:
        self.serial.setdefault(id(node), (len(self.serial), node))  # the node is held, so that its id stays its own
        self.open[id(node)] = (self.seq, *described(node))

    def end(self, node: Node) -> None:
        since, *told = self.open.pop(id(node))
        if since < self.seq:
            self.closed.append((node, since, self.seq, *told))

    def put(self, parent: Node, node: Node, at: int | None = None) -> None:
        super().put(parent, node, at)
        for n in (node, *node.below()):
            self.begin(n)

    def take_out(self, parent: Node, children: list) -> None:
        for c in children:
            for n in (c, *c.below()) if isinstance(c, Node) else ():
                self.end(n)
        super().take_out(parent, children)

    def changed(self, node: Node) -> None:
        self.end(node)
        self.begin(node)

    def step(self, seq: int, action: str, args_json: str | None) -> None:
        self.seq = seq
        if not self.try_apply(action, args_json):
            return
        shown = [c for c in self.body.children if isinstance(c, Node)][-self.last :]
        self.views += [(seq, place, self.serial[id(c)][0], c.attrs.get("id", "")) for place, c in enumerate(shown, 1)]

    def versions(self) -> list[tuple]:
        """node (a number), parent (its parent's; null below the body), rank among all that were ever below it, from_seq, to_seq (the edit that ended it; null where it stands), tag, element_id, attrs, text."""
        rank = {id(c): i for p in (self.body, *(n for _, n in self.serial.values())) for i, c in enumerate(p.ever)}
        rows = [*self.closed, *((self.serial[k][1], since, None, *told) for k, (since, *told) in self.open.items())]
        number = lambda n: self.serial[id(n)][0] if id(n) in self.serial else None
        return [(number(n), number(n.parent), rank[id(n)], since, until, *told) for n, since, until, *told in rows]


TREE = "pos long, parent long, tag string, element_id string, attrs string, text string"
STATE = f"{TREE}, children string, last_seq long, base string"
HISTORY = (
    "versions array<struct<node:long,parent:long,rank:long,from_seq:long,to_seq:long,tag:string,element_id:string,attrs:string,text:string>>, "
    "views array<struct<seq:long,place:int,node:long,element_id:string>>"
)
#: The columns of STATE and HISTORY as Arrow has them.
LONG, TEXT = pa.int64(), pa.string()
STATE_TYPES = {"pos": LONG, "parent": LONG, "tag": TEXT, "element_id": TEXT, "attrs": TEXT, "text": TEXT, "children": TEXT, "last_seq": LONG, "base": TEXT}
VERSION = {"node": LONG, "parent": LONG, "rank": LONG, "from_seq": LONG, "to_seq": LONG, "tag": TEXT, "element_id": TEXT, "attrs": TEXT, "text": TEXT}
VIEW = {"seq": LONG, "place": pa.int32(), "node": LONG, "element_id": TEXT}
HISTORY_TYPES = {"versions": pa.list_(pa.struct(list(VERSION.items()))), "views": pa.list_(pa.struct(list(VIEW.items())))}
#: Rows, read and made, after which what was made goes on to Spark.
AT_ONCE = 4096


def edits_with_bases(edits: DataFrame, live: DataFrame, bases: DataFrame | None) -> DataFrame:
    """session_id, seq, action, args_json, base: of each session a row with its base and no seq, and a row for each live edit."""
    sessions = edits.select("session_id").distinct()
    if bases is None:
        sessions = sessions.withColumn("base", F.lit(None).cast("string"))
    else:
        sessions = bases.select("session_id", base_fragment(F.col("image_url")).alias("base")).join(sessions, "session_id", "full_outer")
    return sessions.unionByName(numbered_edits(live), allowMissingColumns=True).select("session_id", "seq", "action", "args_json", "base")


def numbered_edits(edits: DataFrame) -> DataFrame:
    """Edits of a known session and place."""
    return edits.where(F.col("session_id").isNotNull() & F.col("seq").isNotNull()).select("session_id", F.col("seq").cast("long").alias("seq"), "action", "args_json")


def fold_sessions(rows: DataFrame, order: list[str | Column], fold, schema: str, types: dict[str, pa.DataType]) -> DataFrame:
    """session_id and the columns of schema: what fold makes of each session's rows (tuples in the columns' order), given in order.

    Sessions are dealt to as many tasks as Spark shuffles to, few bytes of edits being much work. A task goes through its sessions one
    after the other and holds one at a time, as one stream: a pandas frame or a stream of its own for each costs more than its edits.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema["session_id"].dataType.simpleString()
    # Dealt by a hash of its own: Spark leaves out what it takes as dealt by session already, such as a union whose tables it merges apart.
    dealt = rows.repartition(n, F.xxhash64("session_id")).sortWithinPartitions("session_id", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, own = ["session_id", *types], []

        def each() -> Iterator[tuple]:
            for b in batches:
                own[:] = [b.schema.field(0).type]
                yield from zip(*(c.to_pylist() for c in b.columns))

        def batch(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), [*own, *types.values()])], names=names)

        made, took = [], 0
        for session, steps in groupby(each(), key=lambda r: r[0]):
            steps = list(steps)
            out = fold(steps)
            made += [(session, *r) for r in out]
            took += len(steps) + len(out)
            if took >= AT_ONCE:
                yield batch(made)
                made, took = [], 0
        if made:
            yield batch(made)

    return dealt.mapInArrow(run, f"session_id {kind}, {schema}")


def replay_state(edits: DataFrame, bases: DataFrame | None = None, allow_external: bool = False) -> DataFrame:
    """session_id and the columns of STATE: each session's notebook after its edits that left a trace, as a table that resumed() goes on from.

    edits: session_id, seq, action, args_json, render_ok, and invalid where calls were validated. bases (session_id, image_url):
    images that stand first in the notebook, and again after a clear. Nothing before a session's last clear is shipped. A
    session's edits since are folded in one task, as each acts on what the others left; sessions without edits have their
    base alone. An edit whose arguments are null, no object or not usable leaves no trace, and the session goes on.
    """
    live = since_clear(effective(edits), F.col("action").isin("clear", "clear_element"))

    def fold(steps: list[tuple]) -> list[tuple]:
        canvas, last = Canvas(steps[0][4], allow_external), 0
        for _, seq, action, args_json, _ in steps:
            if seq is not None:
                canvas.try_apply(action, args_json)
                last = seq
        return canvas.state(last)

    return fold_sessions(edits_with_bases(edits, live, bases), ["seq", F.desc_nulls_last("base")], fold, STATE, STATE_TYPES)


def tree_of(state: DataFrame) -> DataFrame:
    return state.where(F.col("pos") >= 0).drop("children", "last_seq", "base")


def replay_tree(edits: DataFrame, bases: DataFrame | None = None, allow_external: bool = False) -> DataFrame:
    """session_id and the columns of TREE: the elements of replay_state() without the body."""
    return tree_of(replay_state(edits, bases, allow_external))


def resumed(state: DataFrame, edits: DataFrame, allow_external: bool = False) -> DataFrame:
    """The state after more edits, as replay_state() makes it of all edits. Only notebooks that have new edits are shuffled and folded.

    Edits up to a notebook's last_seq are passed over, so that a batch that comes again changes nothing. Sessions
    without a state begin anew, without a base.
    """
    new = numbered_edits(effective(edits))
    touched = new.select("session_id").distinct()
    own = state.join(touched, "session_id", "left_semi").select("session_id", "pos", "tag", "attrs", "children", "last_seq", "base")
    rows = own.unionByName(new, allowMissingColumns=True).select("session_id", "seq", "action", "args_json", *own.columns[1:])

    def go_on(steps: list[tuple]) -> list[tuple]:
        stored = [dict(zip(("pos", "tag", "attrs", "children", "last_seq", "base"), r[4:])) for r in steps if r[1] is None]
        canvas = Canvas.stored(stored, allow_external) if stored else Canvas(None, allow_external)
        last = stored[0]["last_seq"] if stored else 0
        for _, seq, action, args_json, *_ in steps:
            if seq is not None and seq > last:
                canvas.try_apply(action, args_json)
                last = seq
        return canvas.state(last)

    folded = fold_sessions(rows, ["seq", "pos"], go_on, STATE, STATE_TYPES)
    return state.join(touched, "session_id", "left_anti").unionByName(folded)


def replay_history(edits: DataFrame, bases: DataFrame | None = None, allow_external: bool = False, last: int = 3) -> DataFrame:
    """session_id and the columns of HISTORY: all versions of each notebook, and what a render shows after each edit that left a trace, from one fold.

    An element stands, as told, from the edit from_seq on until the edit to_seq; 0 is the start. At any edit the elements that stand, each
    parent's by rank, are the notebook. The table grows with what edits change, not with the notebook for each edit.
    """

    def fold(steps: list[tuple]) -> list[tuple]:
        canvas = History(steps[0][4], allow_external, last)
        for _, seq, action, args_json, _ in steps:
            if seq is not None:
                canvas.step(seq, action, args_json)
        return [([dict(zip(VERSION, v)) for v in canvas.versions()], [dict(zip(VIEW, v)) for v in canvas.views])]

    return fold_sessions(edits_with_bases(edits, effective(edits), bases), ["seq", F.desc_nulls_last("base")], fold, HISTORY, HISTORY_TYPES)


def element_versions(history: DataFrame) -> DataFrame:
    return history.select("session_id", F.explode("versions").alias("v")).select("session_id", "v.*")


def tree_at(versions: DataFrame, seq: int) -> DataFrame:
    """The elements that stand after the edit seq."""
    return versions.where((F.col("from_seq") <= seq) & (F.col("to_seq").isNull() | (F.col("to_seq") > seq)))


def views_by_edit(history: DataFrame) -> DataFrame:
    """session_id, seq, place, node, element_id: the last elements below the body after each edit, as its render shows them."""
    return history.select("session_id", F.explode("views").alias("v")).select("session_id", "v.*")


def base_fragment(image_url: Column) -> Column:
    """The figure that a notebook begins with, a fixed value around its image; null where the image was not found."""
    return F.when(F.coalesce(image_url, F.lit("")) != "", F.concat(F.lit("<figure id='base_figure'><img id='base_image' src='"), image_url, F.lit("'/></figure>")))


def body_children(tree: DataFrame, last: int = 3) -> DataFrame:
    """The last elements directly below the body, which a render shows."""
    return viewport(tree.where(F.col("parent").isNull()), last)
