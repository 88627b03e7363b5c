"""Field rules of the derived feed, as SQL text that Spark and the checking engine both run.

They define the *input*: which train, location and time a table row stands for.
"""

from __future__ import annotations


def digits(date: str) -> str:
    return f"replace(cast(cast({date} as date) as string), '-', '')"


def hhmm(minute: str) -> str:
    hour = f"lpad(cast(cast(floor(({minute}) / 60) as bigint) as string), 2, '0')"
    return f"concat({hour}, ':', lpad(cast(({minute}) % 60 as string), 2, '0'))"


K = "o_orderkey"
POINTS = f"(3 + {K} % 6)"
RID = f"concat({digits('o_orderdate')}, lpad(cast({K} as string), 8, '0'))"
# A uid has six characters by contract, so beyond 100 000 orders two trains share one; nothing is
# joined by it alone.
UID = f"concat('C', lpad(cast({K} % 100000 as string), 5, '0'))"
SSD = "cast(cast(o_orderdate as date) as string)"

# A tenth of the documents carry a second train, which holds the last point.
TWO_TRAINS = f"({K} % 10 = 0)"
RID_2 = f"concat('9', substr({RID}, 2, 15))"
UID_2 = f"concat('D', lpad(cast({K} % 100000 as string), 5, '0'))"

# Message time: ten days, the later half of the documents in key order follow a snapshot.
DOC_TS = (
    f"concat('2024-01-', lpad(cast(1 + {K} % 10 as string), 2, '0'), 'T', "
    f"{hhmm(f'({K} * 7) % 1440')}, ':00')"
)


def place(i: str) -> str:
    """Location code; the last call of every eleventh journey is at its first location again."""
    step = f"(case when {K} % 11 = 0 and {i} = {POINTS} - 1 then 0 else {i} end)"
    return f"concat('T', cast((o_custkey + {step} * (1 + {K} % 3)) % 997 as string))"


def minute(i: str) -> str:
    return f"(({K} * 37 + {i} * 95) % 1440)"


def wta(i: str) -> str:
    return f"concat({hhmm(minute(i))}, case when ({K} + {i}) % 2 = 0 then ':30' else ':00' end)"


def wtd(i: str) -> str:
    return f"concat({hhmm(f'({minute(i)} + 2) % 1440')}, ':00')"


def has_pta(i: str) -> str:
    return f"(({K} + {i}) % 6 <> 5)"


def pta(i: str) -> str:
    return hhmm(minute(i))


def ptd(i: str) -> str:
    return hhmm(f"({minute(i)} + 2) % 1440")


def et(i: str) -> str:
    """Estimate between ten minutes early and nineteen late, across midnight too."""
    return hhmm(f"({minute(i)} + {K} % 30 + 1430) % 1440")


def shape(i: str) -> str:
    """0 arrival and departure, 1 arrival without estimate and departure, 2 departure, 3 neither."""
    return f"(({K} + {i}) % 4)"


def has_platform(i: str) -> str:
    return f"(({K} + {i}) % 5 <> 0)"


def platform(i: str) -> str:
    return f"cast(1 + ({K} + {i}) % 20 as string)"


# Broken frames, in the order a reader meets the trouble.
FRAME_REASON = f"""(case
    when {K} % 17 = 1 then 'missing_header'
    when {K} % 13 = 1 then 'bad_body'
    when {K} % 29 = 1 then 'bad_xml'
    when {K} % 19 = 1 then 'other_version'
    when {K} % 23 = 1 then 'no_train_status'
  end)"""

