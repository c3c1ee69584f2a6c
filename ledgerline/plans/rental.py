"""Reports and jobs over a film rental schema.

``RentalTables`` joins the base tables into the relation each report reads; the
reports themselves take those relations, so any table with the columns will do.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import arguments
from ledgerline.functions import calendar as cal
from ledgerline.functions.numbers import MONEY, total
from ledgerline.functions.text import AUDIENCE_BY_RATING, in_texts, join_skipping_nulls, label_for, same_text
from ledgerline.operators import mutate, windows
from ledgerline.operators.lookup import left_join_many, not_in, present, thin
from ledgerline.operators.ordering import ascending, top_k, top_rank_per_group
from ledgerline.operators.patterns import TrigramIndex
from ledgerline.operators.pivot import conditional_counts


@dataclass(frozen=True)
class RentalTables:
    """The base tables a caller has; only those a relation needs must be set."""

    film: DataFrame | None = None
    category: DataFrame | None = None
    film_category: DataFrame | None = None
    actor: DataFrame | None = None
    film_actor: DataFrame | None = None
    language: DataFrame | None = None
    inventory: DataFrame | None = None
    rental: DataFrame | None = None
    payment: DataFrame | None = None
    customer: DataFrame | None = None
    staff: DataFrame | None = None
    store: DataFrame | None = None
    address: DataFrame | None = None
    city: DataFrame | None = None
    country: DataFrame | None = None

    def films_by_category(self) -> DataFrame:
        """``film_id, title, release_year, rental_rate, category`` through the bridge."""
        named = self.film_category.join(self.category, "category_id", "inner").select(
            "film_id", F.col("name").alias("category")
        )
        return self.film.join(named, "film_id", "inner").select(
            "film_id", "title", "release_year", "rental_rate", "category"
        )

    def payments_by_film(self) -> DataFrame:
        """``amount, payment_date, film_id``: payment to rental to inventory."""
        paid = self.payment.select("rental_id", "amount", "payment_date")
        return (
            paid.join(self.rental.select("rental_id", "inventory_id"), "rental_id", "inner")
            .join(self.inventory.select("inventory_id", "film_id", "store_id"), "inventory_id", "inner")
            .select("film_id", "store_id", "amount", "payment_date")
        )

    def payments_by_category(self) -> DataFrame:
        named = self.films_by_category().select("film_id", F.col("category").alias("category_name"))
        return self.payments_by_film().join(named, "film_id", "inner").select("category_name", "amount", "payment_date")

    def payments_by_store(self) -> DataFrame:
        return self.payments_by_film().select("store_id", "amount", "payment_date")

    def store_addresses(self) -> DataFrame:
        return self.store.join(self.address, "address_id", "inner").select("store_id", "address", "address2")

    def rentals_by_country(self) -> DataFrame:
        """``country, film_id`` of every rental, by the renter's address."""
        home = (
            self.customer.select("customer_id", "address_id")
            .join(self.address.select("address_id", "city_id"), "address_id", "inner")
            .join(self.city.select("city_id", "country_id"), "city_id", "inner")
            .join(self.country.select("country_id", "country"), "country_id", "inner")
            .select("customer_id", "country")
        )
        return (
            self.rental.select("inventory_id", "customer_id")
            .join(self.inventory.select("inventory_id", "film_id"), "inventory_id", "inner")
            .join(home, "customer_id", "inner")
            .select("country", "film_id")
        )

    def films_with_language(self) -> DataFrame:
        named = self.language.select("language_id", F.col("name").alias("language"))
        return self.film.join(named, "language_id", "inner")


# -- reports -----------------------------------------------------------------


def catalogue(
    films: DataFrame,
    category: str = "Animation",
    first_year: int = 2017,
    last_year: int = 2019,
    rate_above: float = 1,
) -> DataFrame:
    """Titles of one category, range of years and minimum rate, alphabetical."""
    return (
        films.filter(
            same_text(F.col("category"), category)
            & F.col("release_year").between(first_year, last_year)
            & (F.col("rental_rate") > rate_above)
        )
        .select(F.col("title").alias("movie_name"))
        .orderBy(*ascending("movie_name"))
    )


def revenue_by_address(payments: DataFrame, stores: DataFrame, since: dt.date = dt.date(2017, 4, 1)) -> DataFrame:
    """Revenue per store address text from ``since`` on; stores with the same address add up.

    Payments are summed per store before they meet the addresses.
    """
    per_store = (
        payments.filter(F.col("payment_date") >= F.lit(since))
        .groupBy("store_id")
        .agg(total(F.col("amount")).alias("revenue"))
    )
    address = F.trim(F.concat(F.col("address"), F.lit(" "), F.coalesce(F.col("address2"), F.lit(""))))
    return (
        per_store.join(stores, "store_id", "inner")
        .groupBy(address.alias("entire_address"))
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_first(), *ascending("entire_address"))
    )


def busiest_actors(
    credits: DataFrame, films: DataFrame, actors: DataFrame, after_year: int = 2015, n: int = 5
) -> DataFrame:
    """The ``n`` actors with most films released after ``after_year``; namesakes stay apart."""
    recent = films.filter(F.col("release_year") > after_year).select("film_id")
    counts = (
        credits.select("actor_id", "film_id")
        .join(recent, "film_id", "inner")
        .groupBy("actor_id")
        .agg(F.count("film_id").alias("number_movies"))
    )
    named = counts.join(actors.select("actor_id", "first_name", "last_name"), "actor_id", "inner")
    return top_k(named, n, F.col("number_movies").desc_nulls_first(), *ascending("actor_id")).select(
        "actor_id", "first_name", "last_name", "number_movies"
    )


def category_counts_per_year(
    films: DataFrame, names: Mapping[str, str] | None = None, year: str = "release_year"
) -> DataFrame:
    """Films of a few categories per year, newest first.

    A row is kept when its category matches without case; a column counts only the
    exact spelling.
    """
    cells = names or {
        "Drama": "number_of_drama_movies",
        "Travel": "number_of_travel_movies",
        "Documentary": "number_of_documentary_movies",
    }
    kept = films.filter(in_texts(F.col("category"), list(cells)))
    return conditional_counts(kept, [year], "category", cells).orderBy(F.col(year).desc_nulls_first())


def top_staff(
    payments: DataFrame, staff: DataFrame, year: int = 2017, n: int = 3, last_store: str = "staff"
) -> DataFrame:
    """The ``n`` staff members with most revenue in a year, and their last store.

    ``last_store="staff"`` reads the store from the staff row. ``"payment"`` takes
    the store of the latest payment ever made (``payments.store_id``, ties by
    ``payment_id``); that scan meets only the ``n`` chosen members, whose number
    bounds the broadcast.
    """
    revenue = (
        payments.filter(cal.in_years(F.col("payment_date"), year, year))
        .groupBy("staff_id")
        .agg(total(F.col("amount")).alias("total_revenue"))
    )
    order = [F.col("total_revenue").desc_nulls_first(), *ascending("staff_id")]
    named = revenue.join(staff.select("staff_id", "first_name", "last_name", "store_id"), "staff_id", "inner")
    best = top_k(named, n, *order)
    if last_store == "payment":
        latest = (
            payments.join(F.broadcast(best.select("staff_id")), "staff_id", "left_semi")
            .groupBy("staff_id")
            .agg(F.max_by("store_id", F.struct("payment_date", "payment_id")).alias("store_id"))
        )
        best = best.drop("store_id").join(latest, "staff_id", "left")
    elif last_store != "staff":
        raise ValueError("last_store must be 'staff' or 'payment'")
    return best.select("staff_id", "first_name", "last_name", "store_id", "total_revenue").orderBy(*order)


def most_rented(
    rentals: DataFrame, films: DataFrame, n: int = 5, labels: Mapping[str, str] = AUDIENCE_BY_RATING
) -> DataFrame:
    """The ``n`` films with most rentals and the audience their rating stands for."""
    counts = rentals.groupBy("film_id").agg(F.count(F.lit(1)).alias("rental_count"))
    named = counts.join(films.select("film_id", "title", "rating"), "film_id", "inner")
    return top_k(named, n, F.col("rental_count").desc_nulls_first(), *ascending("film_id")).select(
        "film_id",
        "title",
        "rental_count",
        "rating",
        label_for(F.col("rating"), labels, "unknown").alias("expected_audience_age"),
    )


def inactivity(credits: DataFrame, actors: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Latest film year of every actor and the years since, longest pause first.

    ``credits`` has ``actor_id, release_year``.
    """
    today = cal.as_of_or_today(as_of)
    latest = credits.groupBy("actor_id").agg(F.max("release_year").alias("latest_movie_year"))
    since = F.year(F.lit(today)) - F.col("latest_movie_year")
    return (
        latest.join(actors.select("actor_id", "first_name", "last_name"), "actor_id", "inner")
        .withColumn("years_since_last_movie", since)
        .select("actor_id", "first_name", "last_name", "latest_movie_year", "years_since_last_movie")
        .orderBy(F.col("years_since_last_movie").desc_nulls_first(), *ascending("actor_id"))
    )


def quarter_revenue(payments: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Revenue per category in the quarter of ``as_of``, best first; only categories that earned.

    ``payments`` has ``category_name, amount, payment_date``.
    """
    start, end = cal.quarter_bounds(cal.as_of_or_today(as_of))
    return (
        payments.filter(cal.in_range(F.col("payment_date"), start, end))
        .groupBy("category_name")
        .agg(total(F.col("amount")).alias("total_sales_revenue"))
        .filter(F.col("total_sales_revenue") > 0)
        .orderBy(F.col("total_sales_revenue").desc_nulls_first(), *ascending("category_name"))
    )


def get_quarter_revenue(
    payments: DataFrame, day: dt.date | None, revenue_type: str = "decimal(10,2)"
) -> DataFrame:
    """``quarter_revenue`` with a required date and a declared revenue type; a sum beyond it is an error."""
    arguments.required(day, "Input date")
    revenue = F.col("total_sales_revenue").cast(revenue_type)
    return quarter_revenue(payments, day).withColumn("total_sales_revenue", revenue)


def quarter_coverage(payments: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """How many payments the quarter has, and its first and last."""
    start, end = cal.quarter_bounds(cal.as_of_or_today(as_of))
    return payments.filter(cal.in_range(F.col("payment_date"), start, end)).agg(
        F.count(F.lit(1)).alias("payments_this_quarter"),
        F.min("payment_date").alias("earliest_payment"),
        F.max("payment_date").alias("latest_payment"),
    )


def popular_by_country(rentals: DataFrame, films: DataFrame, countries: Sequence[str] | None) -> DataFrame:
    """The film(s) rented most in each named country; all films of a tie are returned.

    ``rentals`` has ``country, film_id``. Rentals are counted per film id first, so
    only the counts meet the film table; films are then told apart by what is shown.
    """
    names = arguments.required_list(countries, "Input country list")
    counted = (
        rentals.filter(in_texts(F.col("country"), names))
        .groupBy(F.upper("country").alias("country_name"), "film_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    shown = ["country_name", "film_title", "rating", "language", "length", "release_year"]
    counts = (
        counted.join(
            films.select("film_id", F.col("title").alias("film_title"), "rating", "language", "length", "release_year"),
            "film_id",
            "inner",
        )
        .groupBy(*shown)
        .agg(F.sum("n").alias("rental_count"))
    )
    best = top_rank_per_group(counts, ["country_name"], [F.col("rental_count").desc_nulls_first()], 1)
    return best.select(*shown, "rental_count")


def films_in_stock(
    inventory: DataFrame,
    films: DataFrame,
    rentals: DataFrame,
    customers: DataFrame,
    title_pattern: str | None,
    must_match: bool = True,
    titles: TrigramIndex | None = None,
) -> DataFrame:
    """Copies not rented out whose title fits the pattern: one numbered row per past rental.

    ``inventory``: ``inventory_id, film_id``; ``films``: ``film_id, title, language``;
    ``rentals``: ``inventory_id, customer_id, rental_date, return_date``, where an open
    rental has no return date. Numbers follow title, copy, date and customer, over
    sampled ranges, so neither a popular title nor a busy copy ends up in one task.
    ``must_match`` raises when nothing fits, for which one row is looked up. ``titles`` are
    stored trigrams of ``film_id`` and ``title``, with which the films are not scanned.
    """
    pattern = arguments.required_text(title_pattern, "Input title")
    fitting = films.filter(F.col("title").ilike(pattern)) if titles is None else titles.search(films, "film_id", "title", pattern)
    wanted = fitting.select("film_id", F.col("title").alias("film_title"), "language")
    copies = inventory.select("inventory_id", "film_id").join(wanted, "film_id", "inner")
    out = rentals.filter(F.col("return_date").isNull()).select("inventory_id")
    free = not_in(copies, "inventory_id", out, "inventory_id")
    names = customers.select(
        "customer_id",
        join_skipping_nulls(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
    )
    past = rentals.select("inventory_id", "customer_id", "rental_date")
    listed = (
        left_join_many(free, past, ["inventory_id"])
        .join(names, "customer_id", "left")
        # Also without a rental the name is the blank between two empty parts.
        .withColumn("customer_name", F.coalesce("customer_name", F.lit(" ")))
    )
    numbered = windows.number_rows(
        listed,
        ascending("film_title", "inventory_id", "rental_date", "customer_id"),
    )
    # The numbered rows are written by then; one of them is looked up.
    if must_match and numbered.isEmpty():
        raise LookupError(f'No films matching "{pattern}" are currently available.')
    return numbered.select("row_num", "film_title", "language", "inventory_id", "customer_name", "rental_date")


def late_fee(days: Column, duration: Column, rate: Column, replacement: Column) -> Column:
    """Rate within the rental duration, replacement cost after three times as long, else one unit more per day."""
    return (
        F.when(days <= duration, rate.cast(MONEY))
        .when(days > duration * 3, replacement.cast(MONEY))
        .otherwise((rate.cast(MONEY) + (days - duration)).cast(MONEY))
    )


def rental_charges(rentals: DataFrame, films: DataFrame) -> DataFrame:
    """What each rental costs: ``rentals`` (``film_id, rental_date, return_date``, more) with ``amount``."""
    terms = films.select("film_id", "rental_duration", "rental_rate", "replacement_cost")
    days = cal.days_between(F.col("return_date"), F.col("rental_date"))
    fee = late_fee(days, F.col("rental_duration"), F.col("rental_rate"), F.col("replacement_cost"))
    return rentals.join(terms, "film_id", "inner").select(*rentals.columns, days.alias("days"), fee.alias("amount"))


def heavy_customers(rentals: DataFrame, payments: DataFrame, min_rentals: int = 43, min_payments: int = 43) -> DataFrame:
    """Customers with that many different rentals and payments, each child counted on its own.

    Joining the two children first would multiply them per customer.
    """
    rented = rentals.groupBy("customer_id").agg(F.countDistinct("rental_id").alias("n_rentals"))
    paid = payments.groupBy("customer_id").agg(F.countDistinct("payment_id").alias("n_payments"))
    return rented.filter(F.col("n_rentals") >= min_rentals).join(
        paid.filter(F.col("n_payments") >= min_payments), "customer_id", "inner"
    )


def any_customer(customers: DataFrame) -> DataFrame:
    """One customer out of several: the smallest id."""
    return customers.agg(F.min("customer_id").alias("customer_id"))


def customers_with_history(customers: DataFrame, rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """For every name, one customer who has both rentals and payments."""
    active = present(present(customers, rentals, ["customer_id"]), payments, ["customer_id"])
    return active.groupBy("first_name", "last_name").agg(F.min("customer_id").alias("customer_id"))


def customer_with_history(
    customers: DataFrame, rentals: DataFrame, payments: DataFrame, first_name: str, last_name: str
) -> DataFrame:
    named = customers.filter((F.col("first_name") == first_name) & (F.col("last_name") == last_name))
    return customers_with_history(named, rentals, payments)


# -- jobs --------------------------------------------------------------------

# Fixed values of a newly entered film.
NEW_FILM_DURATION_DAYS = 3
NEW_FILM_RATE = "4.99"
NEW_FILM_REPLACEMENT_COST = "19.99"
NEW_FILM_LANGUAGE = "Klingon"
RENTAL_DAYS = 7


def new_films(
    film: DataFrame, language: DataFrame, batch: DataFrame, as_of: dt.date | None = None, chunk: int = 100_000
) -> tuple[DataFrame, DataFrame]:
    """Enter a batch of films as if its rows came one by one in ``seq`` order.

    ``batch``: ``seq, title`` and optionally ``release_year, language``; a missing
    column takes the current year and the default language. Returns the films to
    append with new ids, and the refused rows with a reason: blank title, title
    that exists (without case, earlier rows of the batch count), unknown language.
    """
    today = cal.as_of_or_today(as_of)
    rows = mutate.with_defaults(
        batch, {"release_year": F.year(F.lit(today)), "language": F.lit(NEW_FILM_LANGUAGE)}
    )
    blank = F.col("title").isNull() | (F.trim("title") == "")
    taken = thin(film.select(F.upper("title").alias("__u")), ["__u"]).withColumn("__taken", F.lit(True))
    known = language.groupBy(F.upper("name").alias("__l")).agg(F.min("language_id").alias("language_id"))
    checked = (
        rows.withColumns({"__u": F.upper("title"), "__l": F.upper("language")})
        .join(taken, "__u", "left")
        .join(known, "__l", "left")
    )
    # A row that would be refused anyway does not stand in the way of a later one.
    good = ~blank & F.col("__taken").isNull() & F.col("language_id").isNotNull()
    first = checked.filter(good).groupBy("__u").agg(F.min("seq").alias("__first"))
    judged = checked.join(first, "__u", "left").withColumn(
        "reason",
        F.when(blank, F.lit("title is empty"))
        .when(F.col("__taken"), F.lit("title exists"))
        .when(F.col("seq") > F.col("__first"), F.lit("title exists"))
        .when(F.col("language_id").isNull(), F.lit("unknown language")),
    )
    accepted = judged.filter(F.col("reason").isNull()).select("seq", "title", "release_year", "language_id")
    numbered = mutate.assign_keys(
        accepted, film, "film_id", ascending("seq"), mutate.id_buckets("seq", chunk)
    )
    inserted = numbered.select(
        "film_id",
        "title",
        "release_year",
        "language_id",
        F.lit(NEW_FILM_DURATION_DAYS).alias("rental_duration"),
        F.lit(NEW_FILM_RATE).cast("decimal(4,2)").alias("rental_rate"),
        F.lit(NEW_FILM_REPLACEMENT_COST).cast("decimal(5,2)").alias("replacement_cost"),
        F.lit(today).alias("last_update"),
        "seq",
    )
    refused = judged.filter(F.col("reason").isNotNull()).select("seq", "title", "reason")
    return inserted, refused


def rent_titles(
    inventory: DataFrame,
    film: DataFrame,
    staff: DataFrame,
    customer_id: Column | int,
    titles: Sequence[str],
    as_of: dt.date | None = None,
) -> DataFrame:
    """One rental per copy of the titles and staff member of its store, due after seven days."""
    today = cal.as_of_or_today(as_of)
    wanted = film.filter(F.col("title").isin(list(titles))).select("film_id")
    renter = customer_id if isinstance(customer_id, Column) else F.lit(customer_id)
    rows = (
        present(inventory, wanted, ["film_id"], unique=True)
        .select("inventory_id", "store_id")
        .join(staff.select("staff_id", "store_id"), "store_id", "inner")
    )
    return (
        rows.withColumn("customer_id", renter)
        .filter(F.col("customer_id").isNotNull())
        .select(
            F.lit(today).alias("rental_date"),
            "inventory_id",
            "customer_id",
            "staff_id",
            F.date_add(F.lit(today), RENTAL_DAYS).alias("return_date"),
            F.lit(today).alias("last_update"),
        )
    )


def take_over_customer(
    tables: RentalTables,
    person: Mapping[str, Column],
    titles: Sequence[str],
    as_of: dt.date | None = None,
    min_rentals: int = 43,
    min_payments: int = 43,
    chunk: int = 100_000,
) -> dict[str, DataFrame]:
    """Give one heavy customer new personal data and a fresh start with the listed titles.

    The customer row is updated, the customer's payments and rentals are deleted, every
    copy of the titles is rented for a week and paid for at what the film's terms ask.
    Returns the new ``customer``, ``rental`` and ``payment``; without a customer heavy
    enough nothing changes.
    """
    today = cal.as_of_or_today(as_of)
    chosen = any_customer(heavy_customers(tables.rental, tables.payment, min_rentals, min_payments))
    customer = mutate.update_where_key(tables.customer, chosen, "customer_id", person)
    rentals = mutate.delete_keys(tables.rental, chosen, ["customer_id"])
    payments = mutate.delete_keys(tables.payment, chosen, ["customer_id"])

    rented = rent_titles(
        tables.inventory, tables.film, tables.staff, chosen.select("customer_id").scalar(), titles, today
    )
    copies = mutate.id_buckets("inventory_id", chunk)
    rented = mutate.assign_keys(rented, tables.rental, "rental_id", ascending("inventory_id", "staff_id"), copies)
    of_film = rented.join(tables.inventory.select("inventory_id", "film_id"), "inventory_id", "inner")
    paid = rental_charges(of_film, tables.film).select(
        "customer_id", "staff_id", "rental_id", "amount", F.lit(today).alias("payment_date")
    )
    numbers = mutate.id_buckets("rental_id", chunk)
    paid = mutate.assign_keys(paid, tables.payment, "payment_id", ascending("rental_id"), numbers)

    def grown(table: DataFrame, rows: DataFrame) -> DataFrame:
        known = [c for c in rows.columns if c in table.columns]
        return table.unionByName(rows.select(*known), allowMissingColumns=True)

    return {"customer": customer, "rental": grown(rentals, rented), "payment": grown(payments, paid)}
