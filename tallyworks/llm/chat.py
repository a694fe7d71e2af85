"""Conversations as training text: a grammar, its round trip, and a loss mask.

    conversation = turn*                turn = reply | said
    reply = "<s>" text "</s>"           an assistant's turn, under the loss mask
    said  = "[INST]" role "\\n" text "[/INST]"

A text or role holds none of the four control strings. Each turn is rendered as it is and parsed
again; where the turn read back isn't the source, its conflicting content is escaped and the turn is rendered
anew. An escape is the mark U+241B and a digit, which no rendered text holds otherwise; texts that hold neither control
strings nor escapes stay untouched. Turns that parse alone parse in a row, and each whole conversation is parsed once more:
one that does not give its source back ends the job. Results are taken from what was read back.

Rendering, checking and escaping work on single turns, wherever they lie. Only the whole
text, and the digest over it, brings the turns of a conversation together; offsets of the mask are running sums of lengths.

Defined cases: a null text or role is empty; turns go by number (null last), then role, then text, so repeated rows are
turns of their own; rows without conv_id belong to no conversation, so each is one of its own and they never
meet in one group; an empty table formats nothing. Other columns are not read. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings and the mark of an escape, each escape standing for the character behind it.
OPEN_REPLY, CLOSE_REPLY, OPEN_SAID, CLOSE_SAID = "<s>", "</s>", "[INST]", "[/INST]"
ASSISTANT, MARK = "assistant", "␛"
ESCAPES = {"1": "\n", "2": "<", "3": "["}
MARK_ESCAPE = "0"

CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]"
#: The first character of a control string, by the digit that escapes it.
OPENING = {"2": r"<(?=/?s>)", "3": r"\[(?=/?INST\])"}


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once. Inside a lambda an outer expression, also a column that the
    optimizer puts in its place, would be made again for every element; a lambda's own variable is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def escaped(text: Column, line_ends: bool = False) -> Column:
    """Without control strings; a role has no line end either."""
    out = F.replace(text, F.lit(MARK), F.lit(MARK + MARK_ESCAPE))
    for digit, pattern in OPENING.items():
        out = F.regexp_replace(out, pattern, MARK + digit)
    return F.replace(out, F.lit("\n"), F.lit(MARK + "1")) if line_ends else out


def unescaped(text: Column) -> Column:
    out = text
    for digit, character in [*ESCAPES.items(), (MARK_ESCAPE, MARK)]:
        out = F.replace(out, F.lit(MARK + digit), F.lit(character))
    return F.when(F.contains(text, F.lit(MARK)), out).otherwise(text)


def rendered(role: Column, text: Column) -> Column:
    reply = F.concat(F.lit(OPEN_REPLY), text, F.lit(CLOSE_REPLY))
    said = F.concat(F.lit(OPEN_SAID), role, F.lit("\n"), text, F.lit(CLOSE_SAID))
    return F.when(role == ASSISTANT, reply).otherwise(said)


def turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text, array<struct<role, text>>; null where it isn't of the grammar."""
    pieces = F.struct(F.regexp_extract_all(formatted, F.lit(CONTROL), F.lit(0)).alias("tokens"),
                      F.split(formatted, CONTROL).alias("texts"))
    return bound(pieces, lambda p: _turns(p["tokens"], p["texts"]))


def _turns(tokens: Column, texts: Column) -> Column:
    """The turns that control strings and the texts between them make."""
    n = F.floor(F.size(tokens) / 2).cast("int")

    def read(i: Column) -> Column:
        begin, end, body = F.get(tokens, 2 * i), F.get(tokens, 2 * i + 1), F.get(texts, 2 * i + 1)
        line_end = F.locate("\n", body)
        role = F.substring(body, F.lit(1), line_end - 1)
        said = F.when((begin == OPEN_SAID) & (end == CLOSE_SAID) & (line_end > 0),
                      turn(unescaped(role), unescaped(F.substring(body, line_end + 1, F.char_length(body)))))
        reply = F.when((begin == OPEN_REPLY) & (end == CLOSE_REPLY), turn(F.lit(ASSISTANT), unescaped(body)))
        # nothing may stand before a turn
        return F.when(F.get(texts, 2 * i) == "", F.coalesce(reply, said))

    turns = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), read)).otherwise(
        F.array().cast("array<struct<role:string,text:string>>"))
    sound = (F.size(tokens) % 2 == 0) & (F.element_at(texts, -1) == "")
    return F.when(sound, bound(turns, lambda all_: F.when(~F.exists(all_, lambda t: t.isNull()), all_)))


def with_rendering(turns: DataFrame) -> DataFrame:
    """Add ``rendered``, which parses to exactly the turn's role and text, and ``body``, what stands for the text in it."""
    role, text = F.col("role"), F.col("text")
    kept = F.array(turn(role, text))
    as_is = turns.withColumn("rendered", rendered(role, text))
    sound = parsed(F.col("rendered")).eqNullSafe(kept)
    as_is = as_is.withColumn("sound", sound)
    return as_is.withColumns({
        "rendered": F.when(F.col("sound"), F.col("rendered")).otherwise(rendered(escaped(role, True), escaped(text))),
        "body": F.when(F.col("sound"), text).otherwise(escaped(text)),
    }).drop("sound")


def formatted(rows: DataFrame) -> DataFrame:
    """A row for each conversation: conv_id, formatted, turns (read back), and loss, the place of each text under the mask:
    start and length in code points, first_byte and n_bytes in UTF-8, which can be cut out without counting up to it."""
    order = [F.col("turn").isNull(), F.col("turn"), F.col("role"), F.col("text")]
    # a row without conversation is one of its own
    group = F.when(rows["conv_id"].isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    turns = rows.select(
        rows["conv_id"].alias("conv_id"), group.alias("own"), rows["turn"].alias("turn"),
        F.coalesce(rows["role"], F.lit("")).alias("role"), F.coalesce(rows["text"], F.lit("")).alias("text"))
    made = with_rendering(turns)
    key = ["conv_id", "own"]
    so_far = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("rendered")).over(so_far), F.lit(0))
    first_byte = F.coalesce(F.sum(F.octet_length("rendered")).over(so_far), F.lit(0))
    placed = made.withColumns({"begin": start, "first_byte": first_byte, "nth": F.row_number().over(Window.partitionBy(*key).orderBy(*order))})
    span = F.when(F.col("role") == ASSISTANT, F.struct(
        (F.col("begin") + len(OPEN_REPLY)).alias("start"), F.char_length("body").cast("long").alias("length"),
        (F.col("first_byte") + len(OPEN_REPLY)).alias("first_byte"), F.octet_length("body").cast("long").alias("n_bytes")))
    one = F.struct("nth", "rendered", turn(F.col("role"), F.col("text")).alias("turn"), span.alias("span"))
    whole = placed.groupBy(*key).agg(F.array_sort(F.collect_list(one)).alias("all"))
    whole = whole.select(
        "conv_id", F.array_join(F.transform("all", lambda t: t["rendered"]), "").alias("formatted"),
        F.transform("all", lambda t: t["turn"]).alias("source"),
        F.array_compact(F.transform("all", lambda t: t["span"])).alias("loss"))
    back = whole.withColumn("turns", parsed(F.col("formatted")))
    same = F.col("turns").eqNullSafe(F.col("source"))
    message = F.concat(F.lit("conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")),
                       F.lit(" does not read back as it was written"))
    checked = F.when(same, F.col("turns")).otherwise(F.raise_error(message).cast("array<struct<role:string,text:string>>"))
    return back.select("conv_id", "formatted", checked.alias("turns"), "loss")


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the formatted text."""
    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    done = formatted(rows)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = bound(F.col("formatted").cast("binary"), lambda whole: F.transform("loss", lambda s: unescaped(F.substring(
        whole, (s["first_byte"] + 1).cast("int"), s["n_bytes"].cast("int")).cast("string"))))
    read = done.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"),
                       F.array_join(said, "").alias("said"), F.array_join(masked, "").alias("under_loss"))
    return read.select(
        "conv_id", "n_turns", digest(F.col("said")).alias("turns_sha256"),
        F.char_length("under_loss").cast("long").alias("loss_chars"), digest(F.col("under_loss")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def write(rows: DataFrame, path: str) -> None:
    """Formatted conversations with their masks, as Parquet."""
    formatted(rows).select("conv_id", "formatted", "loss").write.parquet(path)
