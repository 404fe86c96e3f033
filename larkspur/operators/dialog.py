"""Multi-turn search conversations, folded in batch over a table of turns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .search import AXIS_PHRASES
from .sparse import containing

MAX_TEXT, MAX_TURNS, HISTORY, IDLE_HOURS, MAX_SESSIONS, EVIDENCE = 300, 40, 6, 6, 200, 500
# Words of gender, markers of refining, of pointing at a result, and spelled numbers.
GENDER_WORDS = {"nam": "Nam", "nữ": "Nữ", "nu": "Nữ", "unisex": "Unisex"}
REFINE = ("hơn", "khác", "còn gì", "còn chai", "thêm", "nữa", "thì sao", "vẫn", "nhưng", "đổi", "bớt")
POINT = ("chai thứ", "chai số", "cái thứ", "cái số", "chai đầu", "cái đầu", "chai cuối", "chai đó", "cái đó", "chai này", "chai trên", "em đó", "chai vừa")
THAT_ONE = ("chai đó", "cái đó", "chai này", "chai trên", "chai vừa")
SPELLED = {"đầu": 1, "nhất": 1, "hai": 2, "ba": 3, "tư": 4, "năm": 5}
SPEAKERS = {"user": "Khách", "assistant": "Bạn"}
SHOWN = "  (đã hiện cho khách: {})"


@dataclass(frozen=True)
class Pointers:
    """The words that point at a shown item: before a digit; before the words of the first and last place;
    before a spelled number; and those that mean the first one.  Places count from 1, or from -1 backwards."""

    before_digits: tuple[str, ...] = ("thứ", "số")
    before_ends: tuple[str, ...] = ("chai", "cái", "em")
    ends: dict[str, int] = field(default_factory=lambda: {"đầu": 1, "cuối": -1})
    before_spelled: tuple[str, ...] = ("thứ", "số", "cái", "chai")
    spelled: dict[str, int] = field(default_factory=lambda: SPELLED)
    that_one: tuple[str, ...] = THAT_ONE


def _any(low: Column, phrases: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(low, F.lit(p))
    return out


def slots(df: DataFrame, text: str = "text", axes: dict[str, str] | None = None, genders: dict[str, str] | None = None) -> DataFrame:
    """Adds axes (of the phrases a text has) and gender (of the first whole word it has)."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.array_distinct(F.array_compact(F.array(*(F.when(F.contains(low, F.lit(p)), F.lit(a)) for p, a in (axes or AXIS_PHRASES).items()))))
    gender = F.coalesce(*(F.when(F.rlike(low, F.lit(rf"(?U)\b{w}\b")), F.lit(g)) for w, g in (genders or GENDER_WORDS).items()), F.lit(None).cast("string"))
    return df.withColumns({"axes": found, "gender": gender})


def _one_of(words: Iterable[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def pointed(df: DataFrame, text: str = "text", shown: str = "shown", words: Pointers = Pointers()) -> Column:
    """The shown item a text points at: by a digit, an end of the list, a spelled number or as "that one",
    the first of these that lies in the list; null if there is none."""
    low, s = F.lower(F.trim(F.coalesce(text, F.lit("")))), F.col(shown)
    after = lambda lead, found: F.nullif(F.regexp_extract(low, f"(?U){_one_of(lead)}{found}", 1), F.lit(""))
    place = lambda table: F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    whole = lambda lead, table: place(table)[after(lead, rf"\s+({'|'.join(table)})\b")]
    places = F.array(
        after(words.before_digits, r"\s*(\d+)").try_cast("int"),
        whole(words.before_ends, words.ends),
        whole(words.before_spelled, words.spelled),
        F.when(_any(low, words.that_one), 1),
    )
    inside = F.filter(places, lambda p: (p != 0) & (F.abs(p) <= F.size(s)))
    return F.when(F.size(inside) > 0, F.try_element_at(s, F.get(inside, 0)))


def classified(turns: DataFrame, refine: tuple[str, ...] = REFINE, point: tuple[str, ...] = POINT, words: Pointers = Pointers()) -> DataFrame:
    """Adds action (new, refine, about) and target to user turns.

    turns: conv_id, turn, role, text, shown (items listed by an assistant's turn, else null).  A turn
    is about an item if there was a search before, something is shown and its pointer resolves; it
    refines if there was a search before and it has a marker; else it starts anew.
    """
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    user = F.col("role") == "user"
    rows = turns.withColumn("last_shown", F.last(F.when(F.size("shown") > 0, F.col("shown")), ignorenulls=True).over(before))
    rows = rows.withColumn("earlier", F.count(F.when(user, 1)).over(before) > 0)
    low = F.lower(F.trim(F.coalesce("text", F.lit(""))))
    target = F.when(user & F.col("earlier") & _any(low, point), pointed(rows, "text", "last_shown", words))
    action = F.when(~user, None).when(target.isNotNull(), "about").when(F.col("earlier") & _any(low, refine), "refine").otherwise("new")
    return rows.withColumns({"target": target, "action": action}).drop("earlier")


class _InForce:
    """What a conversation's search has gathered so far: bounded but for the conditions themselves."""

    def __init__(self) -> None:
        self.segment, self.first = 0, None
        self.clear()

    def clear(self) -> None:
        self.tags, self.attributes = {}, {}
        self.axes = self.gender = None
        self.text, self.more, self.first = "", False, None

    def take(self, action: str, tags, attributes, axes, gender, text, min_votes) -> None:
        if action == "new":
            self.segment += 1
            self.clear()
        if self.first is None:
            self.first = (min_votes,)
        self.tags |= dict.fromkeys(tags or ())
        self.attributes |= dict.fromkeys(attributes or ())
        self.axes = axes or self.axes
        self.gender = self.gender if gender is None else gender
        if text:
            whole = (self.text + " " + text).lstrip(" ")
            self.more = self.more or bool(whole[MAX_TEXT:].strip(" "))
            self.text = whole[:MAX_TEXT]

    def said(self) -> str | None:
        """The text so far, trimmed and cut: trailing blanks go unless more follows them."""
        return (self.text if self.more else self.text.rstrip(" ")) or None


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation and turn, one state at a time."""
    last, state = None, _InForce()
    for b in batches:
        out = []
        columns = [b.column(c).to_pylist() for c in ("conv_id", "action", "tags", "attributes", "axes", "gender", "text", "min_votes")]
        for conv, *row in zip(*columns):
            if last != (conv,):
                last, state = (conv,), _InForce()
            state.take(*row)
            out.append((state.segment, list(state.tags), list(state.attributes), state.axes, state.gender, state.said(), state.first[0]))
        names = ["segment", "tags", "attributes", "axes", "gender", "text", "min_votes"]
        strings = pa.list_(pa.string())
        kinds = [pa.int64(), strings, strings, b.schema.field("axes").type, pa.string(), pa.string(), b.schema.field("min_votes").type]
        made = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(names), kinds)]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), *made], ["conv_id", "turn", *names])


def merged(turns: DataFrame) -> DataFrame:
    """The conditions in force after each search turn: tags and attributes add up, axes and gender are
    replaced when given, text is joined and cut, min_votes is the first one's.

    turns: conv_id, turn, action, tags, attributes, axes (arrays), gender, text, min_votes.  A turn
    about an item takes no part in the fold.  Sorted turns stream by, with one state: MAX_TEXT characters of
    text and the conditions that are in force, however many turns a conversation has.
    """
    t = turns.where(F.col("action").isin("new", "refine"))
    t = t.select("conv_id", "turn", "action", "tags", "attributes", "axes", F.col("gender").cast("string").alias("gender"), "text", "min_votes")
    kind = {f.name: f.dataType.simpleString() for f in t.schema}
    schema = f"conv_id {kind['conv_id']}, turn {kind['turn']}, segment long, tags array<string>, attributes array<string>, axes {kind['axes']}, gender string, text string, min_votes {kind['min_votes']}"
    return t.repartition("conv_id").sortWithinPartitions("conv_id", "turn").mapInArrow(_fold, schema)


def last_search(turns: DataFrame) -> DataFrame:
    """Adds the turn of the last search before each turn, passing over turns about an item."""
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumn("last_search", F.last(F.when(F.col("action").isin("new", "refine"), F.col("turn")), ignorenulls=True).over(before))


def with_history(turns: DataFrame, n: int = HISTORY, speakers: dict[str, str] | None = None, shown: str = SHOWN) -> DataFrame:
    """Adds the last n turns as "speaker: text" lines; below a turn that showed items, their numbered list,
    which is what a later turn points at.  turns: conv_id, turn, role, text, shown."""
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-n, -1)
    names = speakers or SPEAKERS
    who = F.coalesce(F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col("role")], F.lit(names["assistant"]))
    numbered = F.array_join(F.transform("shown", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "; ")
    head, tail = shown.split("{}")
    listed = F.when((F.col("role") != "user") & (F.size("shown") > 0), F.concat(F.lit(head), numbered, F.lit(tail)))
    line = F.concat_ws("\n", F.concat_ws(": ", who, F.coalesce("text", F.lit(""))), listed)
    return turns.withColumn("history", F.array_join(F.collect_list(line).over(before), "\n"))


def newest_turns(turns: DataFrame, n: int = MAX_TURNS) -> DataFrame:
    by = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return turns.withColumn("__n", F.row_number().over(by)).where(F.col("__n") <= n).drop("__n")


def sessions(df: DataFrame, key: str, stamp: str, idle_hours: float = IDLE_HOURS) -> DataFrame:
    """(key, session, start, end, n): a gap of more than `idle_hours` starts a session."""
    by = Window.partitionBy(key).orderBy(stamp)
    t = F.unix_micros(F.col(stamp)) if dict(df.dtypes)[stamp] == "timestamp" else F.col(stamp)
    gap = t - F.lag(t).over(by) > F.lit(int(idle_hours * 3_600_000_000))
    rows = df.withColumn("__new", F.when(F.coalesce(gap, F.lit(True)), 1).otherwise(0)).withColumn("session", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "session").agg(F.min(stamp).alias("start"), F.max(stamp).alias("end"), F.count("*").alias("n"))


def kept_sessions(sessions: DataFrame, key: str, n: int = MAX_SESSIONS) -> DataFrame:
    """The n sessions touched last."""
    return sessions.orderBy(F.desc("end"), key, "session").limit(n)


def gated(proposed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(proposal, label): the exact label, else the shortest one that contains the proposal or is
    contained in it; proposals without one are dropped.  Both ways meet by their first letters."""
    p = proposed.select(F.lower(F.trim("proposal")).alias("low"), "proposal").distinct().where("low <> ''")
    v = vocabulary.select("label").where("label <> ''").distinct()
    inside = containing(p.select(F.col("low").alias("part")).distinct(), v).withColumnRenamed("part", "low")
    around = containing(v.select(F.col("label").alias("part")), p.select(F.col("low").alias("label")).distinct())
    around = around.select(F.col("part").alias("label"), F.col("label").alias("low"))
    hit = p.join(inside.select("label", "low").union(around).distinct(), "low")
    order = F.struct(F.when(F.col("label") == F.col("low"), 0).otherwise(1), F.length("label"), "label")
    return hit.groupBy("proposal").agg(F.min_by("label", order).alias("label"))


def json_object(text: Column) -> Column:
    """The JSON object that a text holds, from its first { to its last }; null where that is none."""
    found = F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
    return F.when(F.try_parse_json(found).isNotNull(), found)


# Fixed value: what looks like a name, two capitalised words or more; and the words that count in one.
NAME = r"\b([A-Z][\w']*(?:\s+[A-Z0-9][\w']*)+)"
LONG_WORD = 3


def ungrounded(answers: DataFrame, allowed: DataFrame, key: str = "key", text: str = "text", name: str = NAME, long_word: int = LONG_WORD) -> DataFrame:
    """(key, phrase): the name-like phrases of an answer that no allowed name covers; allowed: key, name.

    A phrase is covered as a whole name, or if it has long words and each of them is an allowed name or
    a long word of one.
    """
    phrases = answers.select(key, F.explode(F.regexp_extract_all(text, F.lit(name), 1)).alias("phrase")).distinct()
    names = allowed.where("name <> ''").select(key, F.lower("name").alias("word"))
    parts = names.select(key, F.explode(F.split("word", r"[\s/&-]+")).alias("word")).where(F.length("word") >= long_word)
    open_ = phrases.join(names.distinct().withColumnRenamed("word", "low"), (F.lower("phrase") == F.col("low")) & (phrases[key] == names[key]), "left_anti")
    words = open_.select(key, "phrase", F.explode(F.split(F.lower("phrase"), r"\s+")).alias("word")).where(F.length("word") >= long_word)
    strange = words.join(names.union(parts).distinct(), [key, "word"], "left_anti").select(key, "phrase")
    bare = open_.join(words.select(key, "phrase"), [key, "phrase"], "left_anti")
    return strange.union(bare).distinct()


# How a reason is named to the reader, by block and label, and the sentences of an answer.
LABELS = {
    "winter": "mùa lạnh", "spring": "mùa xuân", "summer": "mùa nóng", "fall": "mùa thu",
    "day": "ban ngày", "night": "buổi tối", "longevity": "lưu hương lâu", "sillage": "toả hương rõ",
}
BLOCKS = {"acc": "mùi ", "note": "note ", "occ": "hợp ", "str": "", "fam": "họ "}
SENTENCES = {
    "unnamed": "chai này",
    "of": " của {}",
    "best": "Mình nghĩ {} là sát ý bạn nhất{}.",
    "sure": "Chai này có {} lượt đánh giá, trung bình {}/5 — khá nhiều người đã dùng.",
    "unsure": "Mới có {} lượt đánh giá nên điểm {}/5 chưa chắc chắn lắm.",
    "others": "Cùng hướng đó còn có {}, bạn xem thử bên cạnh.",
    "and": " và ",
    "ask": "Bạn thích mùi ngọt ấm hay khô nhẹ hơn?",
    "nothing": "Mình chưa tìm được chai nào khớp ý này. Bạn thử nói theo note hương (ví dụ oud, vanilla, hoa hồng), hoặc theo lúc dùng — "
    "mùa lạnh hay nóng, đi làm hay đi tối?",
    "about": "{}{} thì{}",
    "why": " {}.",
    "no reasons": " mình chưa có đủ dữ liệu về mùi của nó.",
    "its votes": "Có {} lượt đánh giá, trung bình {}/5.",
    "its few votes": "Mới {} lượt đánh giá nên điểm {}/5 chưa chắc chắn.",
    "near": "Gần nó nhất là {}.",
    "compare": "Bạn muốn mình so hai chai này không?",
    "exhausted": "Với điều kiện này thì mình chưa thấy chai nào khác ngoài {} đã gợi lúc trước. Bạn nới bớt một điều kiện nhé — bỏ mùa, "
    "hay cho mình thêm một note hương bạn thích?",
}


def _filled(sentence: str, *values: Column) -> Column:
    """A sentence with its {} filled; null if a value is null."""
    pieces = sentence.split("{}")
    return F.concat(*(x for piece, value in zip(pieces, [*values, F.lit("")], strict=True) for x in (F.lit(piece), value)))


def reason_text(reason: Column, labels: dict[str, str] | None = None, blocks: dict[str, str] | None = None) -> Column:
    """A reason (block, label) in the reader's words."""
    table = lambda t: F.create_map(*(F.lit(x) for kv in t.items() for x in kv))
    head = F.coalesce(table(blocks or BLOCKS)[reason["block"]], F.concat(reason["block"], F.lit(" ")))
    return F.concat(head, F.coalesce(table(labels or LABELS)[reason["label"]], reason["label"]))


def _rating(row: Column, say: dict[str, str], sure: str, unsure: str) -> Column:
    """How far the rating of a row (rating, votes) can be trusted; null without one."""
    number, mean = F.replace(F.format_number(row["votes"], 0), F.lit(","), F.lit(".")), F.format_string("%.2f", row["rating"])
    rated = row["rating"].isNotNull() & (F.coalesce(row["votes"], F.lit(0)) > 0)
    return F.when(rated, F.when(row["votes"] >= EVIDENCE, _filled(say[sure], number, mean)).otherwise(_filled(say[unsure], number, mean)))


def _of_group(row: Column, say: dict[str, str]) -> Column:
    return F.coalesce(_filled(say["of"], F.nullif(row["grp"], F.lit(""))), F.lit(""))


def _reasons(row: Column, labels: dict[str, str] | None) -> Column:
    return F.array_join(F.transform(F.slice(F.coalesce(row["reasons"], F.array()), 1, 3), lambda r: reason_text(r, labels)), ", ")


def answers_about(seeds: DataFrame, results: DataFrame, sentences: dict[str, str] | None = None, labels: dict[str, str] | None = None) -> DataFrame:
    """(query, answer): for queries that point at one item, what that item is like, how sure its rating is,
    which two of its results are nearest, and a question.

    seeds: query, name, grp, rating, votes, reasons (array of block, label), one row a query; results: query, rank,
    name, the items like it.
    """
    say = SENTENCES | (sentences or {})
    near = results.where("rank <= 2 and name is not null").groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "name"))).alias("near"))
    rows = seeds.withColumn("seed", F.struct("name", "grp", "rating", "votes", "reasons")).join(near, "query", "left")
    seed, why = F.col("seed"), _reasons(F.col("seed"), labels)
    head = _filled(say["about"], F.coalesce(seed["name"], F.lit(say["unnamed"])), _of_group(seed, say), F.when(why != "", _filled(say["why"], why)).otherwise(say["no reasons"]))
    names = _filled(say["near"], F.nullif(F.array_join(F.transform("near", lambda x: x["name"]), say["and"]), F.lit("")))
    return rows.select("query", F.concat_ws(" ", head, _rating(seed, say, "its votes", "its few votes"), names, F.lit(say["compare"])).alias("answer"))


def answers_exhausted(results: DataFrame, sentences: dict[str, str] | None = None) -> DataFrame:
    """(query, answer): for queries whose results were all shown before (query, rank, name), which ones these
    were, and what to give up."""
    say = SENTENCES | (sentences or {})
    top = results.where("rank <= 3").groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "name"))).alias("top"))
    names = F.filter(F.transform("top", lambda x: x["name"]), lambda n: n.isNotNull())
    return top.select("query", _filled(say["exhausted"], F.array_join(names, ", ")).alias("answer"))


def answers(results: DataFrame, queries: DataFrame, sentences: dict[str, str] | None = None, labels: dict[str, str] | None = None) -> DataFrame:
    """(query, answer): a templated answer per query (query) from its three best results: the best one with
    its reasons, how sure its rating is, the names of the others, and a question; a sentence of its own
    for a query without results.

    results: query, rank, name, grp, rating, votes, reasons (array of block, label).
    """
    say = SENTENCES | (sentences or {})
    row = F.struct("rank", "name", "grp", "rating", "votes", "reasons")
    top = results.where("rank <= 3").groupBy("query").agg(F.array_sort(F.collect_list(row)).alias("top"))
    first = lambda c: F.get("top", 0)[c]
    name = F.coalesce(first("name"), F.lit(say["unnamed"]))
    one = F.get("top", 0)
    why = _reasons(one, labels)
    best = _filled(say["best"], F.concat(name, _of_group(one, say)), F.when(why != "", F.concat(F.lit(" — "), why)).otherwise(""))
    rating = _rating(one, say, "sure", "unsure")
    names = F.filter(F.transform(F.slice("top", 2, 2), lambda x: x["name"]), lambda n: n.isNotNull())
    others = F.when(F.size(names) > 0, _filled(say["others"], F.array_join(names, say["and"])))
    text = F.concat_ws(" ", best, rating, others, F.lit(say["ask"]))
    rows = queries.select("query").distinct().join(top, "query", "left")
    return rows.select("query", F.when(F.col("top").isNull(), F.lit(say["nothing"])).otherwise(text).alias("answer"))
