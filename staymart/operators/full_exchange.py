"""The whole chain of an exchange: rate type, rate by priority, pivot, spread, rounding.

Rates come from three sources, told apart by their scope: those of a partner, those of a
company's rate type and those of the day. They are one history of candidates, and the first
source in this order with a rate in force wins. A pair without any goes through the pivot, each
leg by the same order.

Rows with one partner, company, date and pair ask the same question. The distinct questions
are narrow; each is answered once, by one lookup of all its candidates, and the answers are
joined back, by the question or, within a key such as the booking's, by that key. Neither lines
nor headers are carried through a lookup.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymart.functions.codes import EURO, RATE_PURPOSE_COLUMNS, SPREAD_COLUMNS
from staymart.operators.asof import BACKWARD, FORWARD, Intervals, asof_lookup, intervals
from staymart.operators.exchange import company_types_at, round_by_currency, with_spread

QUESTION = ("partner", "company", "purpose", "direct", "from_ccy", "to_ccy", "at")
SOURCES = ("partner", "type", "daily")
LEGS = ("direct", "first", "second")
SPREADS = tuple(f"spread_{name}" for name in SPREAD_COLUMNS.values())


def _both_ways(rates: DataFrame, scope: Column, source: str, target: str, effective: str, rate: str, until: Column) -> DataFrame:
    """Stored pairs and their inverses; ``preference`` ranks the stored one higher."""
    value = F.col(rate).cast("double")

    def way(a: str, b: str, found: Column, preference: int) -> Column:
        return F.struct(
            F.col(a).alias("from_ccy"), F.col(b).alias("to_ccy"), found.alias("rate"), F.lit(preference).alias("preference")
        )

    inverse = F.lit(1.0) / F.nullif(value, F.lit(0.0))
    return rates.select(
        scope.alias("scope"),
        F.col(effective).cast("timestamp_ntz").alias("effective"),
        until.cast("timestamp_ntz").alias("until"),
        F.inline(F.array(way(source, target, value, 2), way(target, source, inverse, 1))),
    )


def candidate_rates(
    partner_rates: DataFrame, type_rates: DataFrame | None = None, daily: DataFrame | None = None, pivot: str = EURO
) -> DataFrame:
    """One history of all sources: (scope, from_ccy, to_ccy, effective, until, rate, preference).

    Rates of a day hold on that day alone, against the pivot; of several the largest counts.
    """
    ever = F.lit(None).cast("timestamp_ntz")
    of_partner = F.concat(F.lit("P"), F.col("seq_ttoo").cast("string"))
    history = _both_ways(partner_rates, of_partner, "cod_divisa_ori", "cod_divisa_des", "fec_desde", "nro_tasa", ever)
    if type_rates is not None:
        of_type = F.concat(F.lit("T"), F.col("tipo_cambio"))
        history = history.unionByName(
            _both_ways(type_rates, of_type, "cod_div_origen", "cod_div_destino", "fec_aplicacion", "nro_tasa", ever)
        )
    if daily is not None:
        day = daily.groupBy("date", "currency").agg(F.max(F.col("rate").cast("double")).alias("rate"))
        day = day.filter(F.col("currency") != pivot).withColumn("pivot", F.lit(pivot))
        history = history.unionByName(
            _both_ways(day, F.lit("D"), "currency", "pivot", "date", "rate", F.date_add("date", 1))
        )
    return history


@dataclass(frozen=True)
class RateSources:
    """Prepared histories; company types and spreads may be missing."""

    candidates: Intervals
    company_types: Intervals | None = None
    spreads: Intervals | None = None
    pivot: str = EURO


def rate_sources(tables: Mapping[str, DataFrame], pivot: str = EURO, spreads: bool = True) -> RateSources:
    """Sources from the tables of a working set, stored; only partner_rate has to be there."""
    history = candidate_rates(tables["partner_rate"], *[tables[n] if n in tables else None for n in ("type_rate", "daily_rate")], pivot)
    keys = ["scope", "from_ccy", "to_ccy"]
    candidates = intervals(history, keys, "effective", BACKWARD, ["preference", "rate"], "until").stored()
    types = spread = None
    if "company_rate_type" in tables:
        types = intervals(tables["company_rate_type"], ["semp_cod_emp"], "fec_aplicacion", FORWARD).stored()
    if spreads and "spread" in tables:
        by = ["tipo_cambio", "cod_div_origen", "cod_div_destino"]
        spread = intervals(tables["spread"], by, "fec_aplicacion").stored()
    return RateSources(candidates, types, spread, pivot)


def reject_reason(question: Mapping[str, Column]) -> Column:
    """Why a question can't be asked; null when it can.

    It needs both currencies, a date, and a partner, a company with a known purpose or a
    direct rate type. Within one currency a date and a route are not needed.
    """
    missing = {name: F.col(name) if name not in question else question[name] for name in QUESTION}
    same = missing["from_ccy"] == missing["to_ccy"]
    route = missing["partner"].isNotNull() | missing["direct"].isNotNull()
    known = missing["purpose"].isin(*RATE_PURPOSE_COLUMNS)
    return (
        F.when(missing["from_ccy"].isNull(), "no source currency")
        .when(missing["to_ccy"].isNull(), "no target currency")
        .when(same, None)
        .when(missing["at"].isNull(), "no date")
        .when(route, None)
        .when(missing["company"].isNull(), "no company")
        .when(~F.coalesce(known, F.lit(False)), "unknown purpose")
    )


def _typed(questions: DataFrame, sources: RateSources) -> DataFrame:
    """The rate type: the direct one or the company's for the purpose, if it has one."""
    if sources.company_types is None:
        return questions.withColumn("rate_type", F.col("direct"))
    found = company_types_at(questions, sources.company_types, "company", {"__type": "purpose"}, "at")
    return found.withColumn("rate_type", F.coalesce("direct", "__type")).drop("__type")


def _probes(sources: RateSources) -> Column:
    """Every (leg, priority, scope, pair) that may answer a question, null where it can't.

    Nulls are dropped once they are rows: ``array_compact`` can't be compiled, and an explode over it
    would be interpreted.
    """
    f, t, pivot = F.col("from_ccy"), F.col("to_ccy"), F.lit(sources.pivot)
    direct_only = (f == pivot) | (t == pivot)
    scopes = (F.concat(F.lit("P"), F.col("partner").cast("string")), F.concat(F.lit("T"), F.col("rate_type")), F.lit("D"))
    probes = []
    for leg, (a, b) in zip(LEGS, ((f, t), (f, pivot), (pivot, t)), strict=True):
        for priority, scope in enumerate(scopes):
            wanted = (f != t) & scope.isNotNull()
            if leg != "direct":
                wanted &= ~direct_only
            elif SOURCES[priority] == "daily":
                wanted &= direct_only
            probe = F.struct(
                F.lit(leg).alias("leg"), F.lit(priority).alias("priority"), scope.alias("scope"), a.alias("a"), b.alias("b")
            )
            probes.append(F.when(wanted, probe))
    return F.array(*probes)


def answers(questions: DataFrame, sources: RateSources, carry: Sequence[str] = ()) -> DataFrame:
    """(carry, QUESTION, rate_type, rate, rate_source, spreads) of distinct questions.

    One lookup over all candidates; of each leg the first source in force counts. rate_source
    names it, both for a pair that goes through the pivot.
    """
    typed = _typed(questions.select(*carry, *QUESTION), sources)
    each = typed.select(*typed.columns, F.posexplode(_probes(sources)).alias("__place", "probe"))
    # The first place stays, probe or none, so that no question is lost.
    probed = each.filter((F.col("__place") == 0) | F.col("probe").isNotNull()).select(*typed.columns, "probe.*")
    found = asof_lookup(
        probed, sources.candidates, {"scope": "scope", "a": "from_ccy", "b": "to_ccy"}, "at", {"rate": "found"}
    )
    # A question, leg and source meet one rate at most; sums of plain numbers are hashed.
    held = {
        (leg, source): F.max(F.when((F.col("leg") == leg) & (F.col("priority") == n), F.col("found")))
        for leg in LEGS
        for n, source in enumerate(SOURCES)
    }
    best = found.groupBy(*typed.columns).agg(*[value.alias(f"__{a}_{b}") for (a, b), value in held.items()])
    rate, name = {}, {}
    for leg in LEGS:
        rate[leg] = F.coalesce(*[F.col(f"__{leg}_{source}") for source in SOURCES])
        name[leg] = F.coalesce(*[F.when(F.col(f"__{leg}_{x}").isNotNull(), F.lit(x)) for x in SOURCES])
    direct, first, second = LEGS
    rated = best.select(
        *typed.columns,
        F.coalesce(rate[direct], rate[first] * rate[second]).alias("rate"),
        F.coalesce(name[direct], F.concat(name[first], F.lit("+"), name[second])).alias("rate_source"),
    )
    if sources.spreads is None:
        return rated.withColumns({name: F.lit(0.0) for name in SPREADS})
    by = {"rate_type": "tipo_cambio", "from_ccy": "cod_div_origen", "to_ccy": "cod_div_destino"}
    columns = dict(zip(SPREAD_COLUMNS.values(), SPREADS, strict=True))
    return asof_lookup(rated, sources.spreads, by, "at", columns)


@dataclass(frozen=True)
class Asked:
    """A rate to attach as ``name``; the others are columns, a missing target is the pivot."""

    name: str
    from_ccy: str
    to_ccy: str | None
    at: str
    partner: str | None = None
    company: str | None = None
    purpose: str | Column | None = None
    direct: str | None = None

    def columns(self) -> list[str]:
        """The columns of the rows that a question is made of."""
        names = [self.from_ccy, self.to_ccy, self.at, self.partner, self.company, self.purpose, self.direct]
        return [name for name in names if isinstance(name, str)]

    def question(self, pivot: str) -> dict[str, Column]:
        def column(name: str | Column | None, kind: str) -> Column:
            found = F.lit(None) if name is None else F.col(name) if isinstance(name, str) else name
            return found.cast(kind)

        target = F.lit(pivot) if self.to_ccy is None else F.col(self.to_ccy)
        return {
            "partner": column(self.partner, "long"),
            "company": column(self.company, "string"),
            "purpose": column(self.purpose, "string"),
            "direct": column(self.direct, "string"),
            "from_ccy": F.col(self.from_ccy),
            "to_ccy": target,
            "at": F.col(self.at).cast("timestamp_ntz"),
        }


def attach_rates(
    rows: DataFrame,
    asked: Sequence[Asked],
    sources: RateSources,
    details: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add the rate of each of ``asked``; 1 within one currency, null when there is none.

    With ``details`` also name_type, name_source, name_reason and the three spreads.
    ``within`` names a key of few rows by which they are, or will be, dealt out: questions are
    then told apart by it too, and all answers of a key come back to its rows in one join on it
    alone, so that nothing is moved but by that key. Rows without the key get no answer.
    """
    questions = [a.question(sources.pivot) for a in asked]
    useful = [reject_reason(q).isNull() & (q["from_ccy"] != q["to_ccy"]) for q in questions]
    keys = {name: f"__within_{name}" for name in within}
    entries = [F.when(u, F.struct(*[q[n].alias(n) for n in QUESTION])) for q, u in zip(questions, useful, strict=True)]
    # The key stays a column of its own, so that Spark knows how its rows are dealt out.
    own = [F.col(name).alias(key) for name, key in keys.items()]
    each = rows.select(*own, F.explode(F.array(*entries)).alias("q")).filter(F.col("q").isNotNull())
    distinct = each.select(*keys.values(), "q.*").distinct()
    answered = answers(distinct, sources, list(keys.values()))
    found = [*(["rate_type", "rate_source", *SPREADS] if details else []), "rate"]
    if within:
        return _attach_within(rows, asked, questions, useful, answered, found, keys, details)
    out = rows
    for a, q, u in zip(asked, questions, useful, strict=True):
        side = answered.select(
            *[F.col(n).alias(f"__{a.name}_{n}") for n in QUESTION], F.struct(*found).alias(f"__{a.name}")
        )
        match = u
        for n in QUESTION:
            match = match & q[n].eqNullSafe(F.col(f"__{a.name}_{n}"))
        joined = out.join(side, match, "left")
        out = joined.select(*out.columns, *_outputs(a, q, F.col(f"__{a.name}"), details))
    return out


def _attach_within(
    rows: DataFrame,
    asked: Sequence[Asked],
    questions: Sequence[dict[str, Column]],
    useful: Sequence[Column],
    answered: DataFrame,
    found: Sequence[str],
    keys: dict[str, str],
    details: bool,
) -> DataFrame:
    answer = F.struct(F.struct(*QUESTION), F.struct(*found))
    per_key = answered.groupBy(*keys.values()).agg(F.map_from_entries(F.collect_list(answer)).alias("__answers"))
    match = [F.col(name) == F.col(key) for name, key in keys.items()]
    joined = rows.join(per_key, match, "left")
    outputs = []
    for a, q, u in zip(asked, questions, useful, strict=True):
        key = F.struct(*[q[n].alias(n) for n in QUESTION])
        outputs += _outputs(a, q, F.when(u, F.try_element_at("__answers", key)), details)
    return joined.select(*rows.columns, *outputs)


def _outputs(asked: Asked, question: dict[str, Column], answer: Column, details: bool) -> list[Column]:
    same = question["from_ccy"] == question["to_ccy"]
    columns = {asked.name: F.when(same, F.lit(1.0)).otherwise(answer["rate"])}
    if details:
        columns |= {
            f"{asked.name}_type": answer["rate_type"],
            f"{asked.name}_source": F.when(same, F.lit("same")).otherwise(answer["rate_source"]),
            f"{asked.name}_reason": reject_reason(question),
            **{f"{asked.name}_{n}": F.coalesce(answer[n], F.lit(0.0)) for n in SPREADS},
        }
    return [value.alias(name) for name, value in columns.items()]


class FullConverter:
    """A converter for the plans that knows a booking's partner and company.

    Rows carry these in the columns of ``context``. Where rows have the columns of ``within``,
    a booking's key, its rates come back by that key.
    """

    context = ("partner_ttoo", "rate_company")

    def __init__(
        self, sources: RateSources, purpose: str = "R", within: Sequence[str] = ("grec_seq_rec", "seq_reserva")
    ):
        self.sources, self.purpose, self.within = sources, purpose, tuple(within)

    def __call__(self, df: DataFrame, from_ccy: str, to_ccy: str | None, at: str, out: str) -> DataFrame:
        return self.attach(df, [(out, from_ccy, to_ccy, at)])

    def attach(self, df: DataFrame, rates: Sequence[tuple[str, str, str | None, str]]) -> DataFrame:
        """All of (name, source, target, date) at once, from one set of questions."""
        if not rates:
            return df
        asked = [Asked(*rate, *self.context, F.lit(self.purpose)) for rate in rates]
        within = self.within if set(self.within) <= set(df.columns) else ()
        return attach_rates(df, asked, self.sources, within=within)


def full_exchange(
    rows: DataFrame, sources: RateSources, currencies: DataFrame, asked: Asked, amount: str, kind: str, out: str, rounded: bool = True
) -> DataFrame:
    """Amount in the target currency, with spread of the kind (V, C or F), rounded to it.

    Adds out, out_rate, out_type, out_source and out_reason. Within one currency neither
    rate nor spread applies; without a rate the amount is null.
    """
    rated = attach_rates(rows, [asked], sources, details=True)
    pct = F.lit(0.0)
    for code, name in zip(SPREAD_COLUMNS, SPREADS, strict=True):
        pct = F.when(F.col(kind) == code, F.col(f"{asked.name}_{name}").cast("double")).otherwise(pct)
    value = F.col(amount).cast("double")
    same = F.col(f"{asked.name}_source") == "same"
    raw = F.when(same, value).otherwise(with_spread(value * F.col(asked.name), pct))
    target = f"__{out}_target"
    priced = rated.withColumns({f"__{out}_raw": raw, target: asked.question(sources.pivot)["to_ccy"]})
    if rounded:
        priced = round_by_currency(priced, currencies, f"__{out}_raw", target, out)
    else:
        priced = priced.withColumn(out, F.col(f"__{out}_raw"))
    extra = {f"{asked.name}_{n}": f"{out}_{n}" for n in ("type", "source", "reason")} | {asked.name: f"{out}_rate"}
    return priced.select(*rows.columns, out, *[F.col(a).alias(b) for a, b in extra.items()])


def split_rejects(rows: DataFrame, asked: Asked, folder: str, pivot: str = EURO) -> tuple[DataFrame, DataFrame]:
    """(rows that can be asked for a rate, the others with ``reason``), judged in one run.

    The rows are written once, parted by ``rejected``; either side is then read alone.
    """
    judged = rows.withColumn("reason", reject_reason(asked.question(pivot)))
    judged.withColumn("rejected", F.col("reason").isNotNull()).write.partitionBy("rejected").parquet(folder)
    kept = rows.sparkSession.read.schema(
        T.StructType([*judged.schema.fields, T.StructField("rejected", T.BooleanType())])
    ).parquet(folder)
    good = kept.filter(~F.col("rejected")).select(*rows.columns)
    return good, kept.filter("rejected").drop("rejected")


def reject_counts(rejects: DataFrame) -> DataFrame:
    """How many rows each reason turns away."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_requests"))
