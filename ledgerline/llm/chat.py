"""Chat formatting into budgeted windows, with DataFrame functions only.

Turns of a conversation are ordered by (turn, role, text) and laid on a line by prefix
sums of their tokens. Windows are chosen greedily along it: a window takes turns as long as the
system turn, the history repeated before its first turn and its own turns fit the
budget; the next begins at the first turn beyond. The choice is made inside runs of
``CHUNK`` places, by a fold over at most that many numbers, so a window also ends where
a run ends and a very long conversation is spread over many tasks. Windows end at turns,
and only a window of a single turn can exceed the budget.

Every window begins with the conversation's system turn, then repeats the last turns
before it, at most ``history_turns`` and ``history_tokens`` of them. A system turn that
would take more than half of what the history allowance leaves is not repeated: it is a turn
like any other, in the first window. Assistant texts are targets in the one window they
belong to; repeated turns, system and user texts are masked. Tokens are counted by a
function of the text, or handed in as a column of counts by a real tokenizer.

Template: ``<turn>role<text>text</turn>`` and a line feed. In roles and texts a
backslash is written ``\\b`` and ``<`` is written ``\\l``: no control string can
occur inside them, and ``read_back`` restores them exactly.

Prefix sums are made in two steps, inside runs of ``CHUNK`` turn numbers and over
the runs' totals; history and system turns are fetched by joins on (conversation, place).

Defined cases: NULL text and NULL role are empty; a NULL token count is 0; rows without a turn come
first; rows repeating a turn number are all kept; rows with a NULL conv_id form
one conversation; a system turn counts as such only in first place; a
conversation of a system turn only is one window; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
CHUNK = 256
TOKEN = r"\w+|[^\w\s]"
TURN_TOKENS = 3  # the template's control strings


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def count_tokens(text: Column) -> Column:
    """Words and single marks; any other counter that is a Column can take its place."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def _meet(a: DataFrame, b: DataFrame, *names: str) -> DataFrame:
    """Inner join on equal (NULL with NULL) columns; b's copies of them are dropped."""
    b = b.withColumnsRenamed({n: f"__{n}" for n in names})
    on = F.lit(True)
    for n in names:
        on &= F.col(n).eqNullSafe(F.col(f"__{n}"))
    return a.join(b, on).drop(*[f"__{n}" for n in names])


def _numbered(turns: DataFrame, tokens) -> DataFrame:
    """conv_id, place (from 0), role, text, tokens, begin (tokens before it)."""
    text = F.coalesce("text", F.lit(""))
    counted = F.coalesce(F.col(tokens).cast("long"), F.lit(0).cast("long")) if isinstance(tokens, str) else tokens(text)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), (counted + TURN_TOKENS).alias("tokens"))
    rows = rows.withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("nth", F.count(F.lit(1)).over(inside)).withColumn("upto", F.sum("tokens").over(inside))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("sum"))
    totals = totals.select("conv_id", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum"))
    return _meet(rows, totals, "conv_id", "chunk").select(
        "conv_id",
        (F.col("n") + F.col("nth") - 1).cast("long").alias("place"),
        "role",
        "text",
        "tokens",
        (F.col("sum") + F.col("upto") - F.col("tokens")).cast("long").alias("begin"),
    )


def windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    tokens=count_tokens,
    target_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per window: conv_id, window (increasing within a conversation, not
    gapless), text, n_tokens, turns: array of place, repeated, loss, and where the
    turn's text starts (from 1) and how long it is, in characters of the window.
    The loss mask is the texts of the turns with loss. ``tokens`` is a function of a text
    column, or the name of a column of ``turns``."""
    rows = staged(_numbered(turns, tokens), "numbered-turns")
    first = rows.where("place = 0").select("conv_id", (F.col("role") == "system").alias("system"), F.col("tokens").alias("first_tokens"))
    last = rows.groupBy("conv_id").agg(F.max("place").alias("last"))
    kept = F.col("system") & (F.col("last") > 0) & (2 * F.col("first_tokens") <= budget - history_tokens)
    about = _meet(first, last, "conv_id").select("conv_id", kept.alias("system"), F.when(kept, F.col("first_tokens")).otherwise(0).alias("held"))
    rows = _meet(rows, about, "conv_id")

    own = rows.where(~(F.col("system") & (F.col("place") == 0)))
    # per run of CHUNK places: each turn's tokens, and the room a window has that begins with it
    chunks = own.groupBy("conv_id", "system", "held", F.floor(F.col("place") / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("place", "tokens"))).alias("run"))

    def history(i: Column) -> Column:
        """Tokens repeated before turn i of the run; at a run's beginning, the whole allowance."""
        total, open_ = F.lit(0).cast("long"), F.lit(True)
        for back in range(1, history_turns + 1):
            more = total + F.coalesce(F.get("run", i - back)["tokens"], F.lit(0).cast("long"))
            open_ = open_ & (more <= history_tokens)
            total = F.when(open_, more).otherwise(total)
        known = (i >= history_turns) | (F.col("chunk") == 0)
        return F.when(known, total).otherwise(F.lit(history_tokens).cast("long"))

    turn = F.transform("run", lambda t, i: F.struct(t["place"].alias("place"), t["tokens"].alias("tokens"), (F.lit(budget).cast("long") - F.col("held") - history(i)).alias("room")))
    nothing = F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("long").alias("used"), F.lit(-1).cast("long").alias("room"))

    def step(acc: Column, t: Column) -> Column:
        fits = acc["used"] + t["tokens"] <= acc["room"]
        return F.struct(
            F.when(fits, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(t["place"]))).alias("starts"),
            F.when(fits, acc["used"] + t["tokens"]).otherwise(t["tokens"]).alias("used"),
            F.when(fits, acc["room"]).otherwise(t["room"]).alias("room"),
        )

    chosen = chunks.withColumn("turns", turn).select("conv_id", "system", "held", "chunk", F.aggregate("turns", nothing, step)["starts"].alias("starts"))
    # a window is named by its first place; a turn belongs to the last window of its run that begins at or before it
    own = _meet(own.withColumn("chunk", F.floor(F.col("place") / CHUNK)), chosen.select("conv_id", "chunk", "starts"), "conv_id", "chunk")
    own = own.withColumn("window", F.array_max(F.filter("starts", lambda s: s <= F.col("place")))).drop("starts", "chunk")
    spans = own.groupBy("conv_id", "window", "system").agg(F.min("place").alias("from"), F.min("begin").alias("at"))

    # repeated turns: up to history_turns before a window's first one, and the system turn
    before = F.sequence(F.greatest(F.col("from") - history_turns, F.col("system").cast("long")), F.col("from") - 1)
    past = spans.where(F.col("from") > F.col("system").cast("long")).select("conv_id", "window", "at", F.explode(before).alias("place"))
    system = spans.where("system").select("conv_id", "window", F.lit(None).cast("long").alias("at"), F.lit(0).cast("long").alias("place"), (F.col("from") > 1).alias("repeated"))
    wanted = past.withColumn("repeated", F.lit(True)).unionByName(system)
    fetched = _meet(wanted, rows.select("conv_id", "place", "role", "text", "tokens", "begin"), "conv_id", "place").where(F.col("at").isNull() | (F.col("at") - F.col("begin") <= history_tokens))
    columns = ["window", "place", "role", "text", "tokens", "repeated"]
    parts = own.select("conv_id", *columns[:-1], F.lit(False).alias("repeated")).unionByName(fetched.select("conv_id", *columns))

    head = F.concat(F.lit("<turn>"), escape(F.col("role")), F.lit("<text>"))
    body = escape(F.col("text"))
    loss = ~F.col("repeated") & F.col("role").isin(*target_roles)
    piece = F.struct("place", "repeated", loss.alias("loss"), F.length(head).alias("head"), F.length(body).alias("body"), F.concat(head, body, F.lit("</turn>\n")).alias("piece"))
    made = parts.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(piece)).alias("parts"), F.sum("tokens").alias("n_tokens"))
    # where each piece starts: running sum of piece lengths, by array functions
    begun = F.aggregate("parts", F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p["piece"]))))
    made = made.withColumn("begun", begun)
    described = F.transform(
        "parts",
        lambda p, i: F.struct(p["place"].alias("place"), p["repeated"].alias("repeated"), p["loss"].alias("loss"), (F.col("begun")[i] + p["head"] + 1).alias("start"), p["body"].alias("length")),
    )
    return made.select("conv_id", "window", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"), "n_tokens", described.alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns recovered from the windows' text and mask: conv_id, window, place,
    repeated, role, text, loss_text (NULL if masked), and window_chars, the
    window's length on its first row and 0 on the others."""
    pieces = F.split("text", "</turn>\n", -1)
    turn = F.posexplode(F.arrays_zip(F.slice(pieces, 1, F.size("turns")).alias("piece"), F.col("turns").alias("turn")))
    rows = formatted.select("conv_id", "window", F.col("text").alias("whole"), turn.alias("nth", "item"))
    part = F.split(F.col("item.piece"), "<text>", 2)
    masked = F.substr(F.col("whole"), F.col("item.turn.start"), F.col("item.turn.length"))
    return rows.select(
        "conv_id",
        "window",
        F.col("item.turn.place").alias("place"),
        F.col("item.turn.repeated").alias("repeated"),
        unescape(F.substr(part[0], F.lit(len("<turn>") + 1))).alias("role"),
        unescape(part[1]).alias("text"),
        F.when(F.col("item.turn.loss"), unescape(masked)).alias("loss_text"),
        F.when(F.col("nth") == 0, F.length("whole")).otherwise(0).alias("window_chars"),
    )
