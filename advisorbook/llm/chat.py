"""Chat transcripts that parse back to the very turns they were made from.

A turn is ``<|im_start|>role``, a newline, the text, ``<|im_end|>`` and a newline. Rendered
text is parsed again by a deterministic grammar and the recovered turns are compared to the
source; where they differ, the conflicting content is escaped and rendered anew, until all
conversations come back identical. The escape puts one more backslash between ``<`` and ``|``
wherever only backslashes stand between them, so an escaped text holds no control string, and
the parser takes one away; it is reversible whatever the text holds. In a role, a newline
becomes the control string ``<|nl|>``.

The loss mask of a conversation lists where its assistant texts stand in the rendered text.

A null text or role is empty. Turns stand in order of their number, then role, then text, so
repeated rows are kept side by side; rows with a null conv_id make one conversation; a null
turn number comes first. Further columns are left behind; an empty table gives no rows. A
conversation is one row of the result and so is gathered into one; nothing else is.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisorbook.llm.common import column

# The control strings.
START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
ROUNDS = 2
TURNS = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _body(text: Column, times: int) -> Column:
    return escape(text) if times else text


def render(turns: Column, times: int) -> Column:
    """The turns as one text; ``times`` 0 leaves content as it is, 1 escapes it."""
    def one(t: Column) -> Column:
        role = _body(t["role"], times)
        role = F.replace(role, F.lit("\n"), F.lit(BREAK)) if times else role
        return F.concat(F.lit(START), role, F.lit("\n"), _body(t["text"], times), F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def _raw_turns(formatted: Column) -> Column:
    """Role and text of each turn as they stand in the rendered text; null where the grammar fails."""
    chunks = F.split(formatted, r"<\|im_end\|>\n", -1)
    turns = F.transform(
        F.slice(chunks, F.lit(1), F.size(chunks) - 1),
        lambda c: F.when(
            c.startswith(START) & c.contains("\n"),
            F.struct(
                F.substring_index(F.substring(c, len(START) + 1, 2**31 - 1), "\n", 1).alias("role"),
                F.substring(c, F.locate("\n", c) + 1, F.length(c)).alias("text"),
            ),
        ),
    )
    fits = F.forall(
        turns,
        lambda t: t.isNotNull()
        & ~t["role"].rlike(r"<\|im_(start|end)\|>")
        & ~t["text"].rlike(r"<\|(im_start|im_end|nl)\|>"),
    )
    return F.when(fits & (F.element_at(chunks, -1) == ""), turns)


def parse(formatted: Column) -> Column:
    """The turns of a rendered text; null where it does not follow the grammar."""
    return F.transform(
        _raw_turns(formatted),
        lambda t: F.struct(
            unescape(F.replace(t["role"], F.lit(BREAK), F.lit("\n"))).alias("role"), unescape(t["text"]).alias("text")
        ),
    )


def loss_mask(formatted: Column, role: str = "assistant") -> Column:
    """Start and length, in code points, of the texts of one role."""
    places = F.aggregate(
        _raw_turns(formatted),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda state, t: F.struct(
            (state["at"] + len(START) + F.length(t["role"]) + 1 + F.length(t["text"]) + len(END) + 1).alias("at"),
            F.when(
                t["role"] == role,
                F.concat(
                    state["spans"],
                    F.array(F.struct((state["at"] + len(START) + F.length(t["role"]) + 1).alias("start"), F.length(t["text"]).alias("length"))),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return places


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation with its turns in order."""
    turn = F.struct(
        column("turn").alias("turn"),
        F.coalesce(column("role"), F.lit("")).alias("role"),
        F.coalesce(column("text"), F.lit("")).alias("text"),
    )
    gathered = rows.groupBy(column("conv_id").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return gathered.select("conv_id", F.transform("t", lambda t: F.struct(t["role"], t["text"])).cast(TURNS).alias("turns"))


def format_chats(rows: DataFrame) -> DataFrame:
    """Each conversation rendered so that it parses back to its turns, and its loss mask."""
    rendered = conversations(rows).withColumn("formatted", F.lit(None).cast("string"))
    for times in range(ROUNDS):
        attempt = render(F.col("turns"), times)
        last = F.raise_error(F.lit("a conversation does not parse back")) if times == ROUNDS - 1 else F.lit(None)
        rendered = rendered.withColumn("attempt", F.when(F.col("formatted").isNull(), attempt)).withColumn(
            "formatted",
            F.coalesce(
                "formatted",
                F.when(parse(F.col("attempt")) == F.col("turns"), F.col("attempt")).otherwise(last.cast("string")),
            ),
        )
    return rendered.select("conv_id", "formatted", loss_mask(F.col("formatted")).alias("loss"))


def digest(formatted: DataFrame) -> DataFrame:
    """What the rendered conversations hold, read back from them."""
    turns = parse(F.col("formatted"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(
        F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), ""
    )
    read = formatted.withColumn("turns", turns).withColumn("masked", masked)
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
