"""Rental reports and jobs on small tables with the cases the driver's tables lack."""

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import row_set, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.visibility import entitle, rows_per_user, visible_rows
from ledgerline.plans import rental

T = dt.datetime


@pytest.fixture
def tables(frame):
    return rental.RentalTables(
        film=frame(
            "film_id int, title string, release_year int, language_id int, rental_duration int, "
            "rental_rate decimal(4,2), replacement_cost decimal(5,2), rating string, length int",
            (1, "Love Story", 2018, 1, 3, D("4.99"), D("19.99"), "PG", 90),
            (2, "Glove", 2017, 1, 3, D("0.99"), D("9.99"), "R", 100),
            (3, "Storm", 2016, 2, 5, D("2.99"), D("14.99"), None, 80),
        ),
        category=frame("category_id int, name string", (1, "Animation"), (2, "Drama"), (3, "travel")),
        film_category=frame("film_id int, category_id int", (1, 1), (2, 1), (3, 2), (1, 2), (2, 3)),
        actor=frame("actor_id int, first_name string, last_name string", (1, "A", "Same"), (2, "A", "Same"), (3, "C", "None")),
        film_actor=frame("actor_id int, film_id int", (1, 1), (1, 2), (2, 3), (2, 1), (2, 2), (9, 1)),
        language=frame("language_id int, name string", (1, "English"), (2, "Klingon")),
        inventory=frame("inventory_id int, film_id int, store_id int", (1, 1, 1), (2, 2, 1), (3, 3, 2), (4, 1, 2)),
        rental=frame(
            "rental_id int, rental_date timestamp_ntz, inventory_id int, customer_id int, staff_id int, return_date timestamp_ntz",
            (1, T(2017, 1, 1), 1, 1, 1, T(2017, 1, 3)),
            (2, T(2017, 2, 1), 1, 2, 1, T(2017, 2, 9)),
            (3, T(2017, 5, 1), 2, 1, 1, None),
            (4, T(2017, 5, 2), 3, 2, 2, T(2017, 5, 20)),
        ),
        payment=frame(
            "payment_id int, customer_id int, staff_id int, rental_id int, amount decimal(5,2), payment_date timestamp_ntz",
            (1, 1, 1, 1, D("5.00"), T(2017, 1, 2)),
            (2, 2, 1, 2, D("7.00"), T(2017, 4, 1)),
            (3, 1, 1, 3, D("1.00"), T(2017, 5, 1)),
            (4, 2, 2, 4, D("9.00"), T(2017, 5, 3)),
            (5, 2, 2, 4, D("0.00"), T(2018, 1, 1)),
        ),
        customer=frame(
            "customer_id int, first_name string, last_name string, address_id int", (1, "Ann", "Lee", 1), (2, "Bob", None, 2)
        ),
        staff=frame("staff_id int, first_name string, last_name string, store_id int", (1, "S", "One", 1), (2, "S", "Two", 2)),
        store=frame("store_id int, address_id int", (1, 1), (2, 2)),
        address=frame("address_id int, address string, address2 string, city_id int", (1, "X", None, 1), (2, "Y", "back", 2)),
        city=frame("city_id int, country_id int", (1, 1), (2, 2)),
        country=frame("country_id int, country string", (1, "Peru"), (2, "Chad")),
    )


def test_catalogue(tables):
    assert rows(rental.catalogue(tables.films_by_category())) == [("Love Story",)]
    assert rows(rental.catalogue(tables.films_by_category(), "ANIMATION", 2017, 2018, 0.5)) == [("Glove",), ("Love Story",)]


def test_revenue_by_address_trims_a_missing_part(tables):
    got = rows(rental.revenue_by_address(tables.payments_by_store(), tables.store_addresses()))
    assert [(a, float(r)) for a, r in got] == [("Y back", 9.0), ("X", 8.0)]


def test_namesakes_stay_apart_and_orphan_credits_drop(tables):
    got = rows(rental.busiest_actors(tables.film_actor, tables.film, tables.actor))
    assert got == [(2, "A", "Same", 3), (1, "A", "Same", 2)]


def test_category_counts_are_case_sensitive(tables):
    got = rows(rental.category_counts_per_year(tables.films_by_category()))
    # "travel" passes the filter but its column counts only "Travel".
    assert got == [(2018, 1, 0, 0), (2017, 0, 0, 0), (2016, 1, 0, 0)]


def test_top_staff_store_choices(tables):
    payments = tables.payment.withColumn("store_id", F.col("payment_id") * 10)
    by_staff = rows(rental.top_staff(payments, tables.staff))
    assert [(r[0], r[3], float(r[4])) for r in by_staff] == [(1, 1, 13.0), (2, 2, 9.0)]
    by_payment = rows(rental.top_staff(payments, tables.staff, last_store="payment"))
    assert [(r[0], r[3]) for r in by_payment] == [(1, 30), (2, 50)]
    with pytest.raises(ValueError):
        rental.top_staff(payments, tables.staff, last_store="moon")


def test_most_rented_labels(tables):
    rentals = tables.rental.join(tables.inventory, "inventory_id")
    got = rows(rental.most_rented(rentals, tables.film))
    assert got == [
        (1, "Love Story", 2, "PG", "Parental Guidance Suggested"),
        (2, "Glove", 1, "R", "Children Under 17 Require Accompanying Adult"),
        (3, "Storm", 1, None, "unknown"),
    ]


def test_inactivity(tables):
    credits = tables.film_actor.join(tables.film, "film_id")
    got = rows(rental.inactivity(credits, tables.actor, dt.date(2020, 1, 1)))
    assert [(r[0], r[3], r[4]) for r in got] == [(1, 2018, 2), (2, 2018, 2)]


def test_quarter_revenue(tables):
    payments = tables.payments_by_category()
    got = rows(rental.quarter_revenue(payments, dt.date(2017, 6, 30)))
    # Film 1 and 2 have two categories each, so their payments count in both.
    assert [(n, float(v)) for n, v in got] == [("Drama", 16.0), ("Animation", 8.0), ("travel", 1.0)]
    assert rows(rental.quarter_revenue(payments, dt.date(2018, 2, 1))) == []
    assert str(rental.get_quarter_revenue(payments, dt.date(2017, 6, 1)).schema["total_sales_revenue"].dataType) == "DecimalType(10,2)"
    with pytest.raises(ValueError):
        rental.get_quarter_revenue(payments, None)
    coverage = rows(rental.quarter_coverage(tables.payment, dt.date(2017, 6, 1)))
    assert coverage == [(3, T(2017, 4, 1), T(2017, 5, 3))]


def test_popular_film_ties(tables):
    got = rental.popular_by_country(tables.rentals_by_country(), tables.films_with_language(), ["peru", "CHAD", "Mars"])
    assert row_set(got, "country_name", "film_title", "language") == [
        ("CHAD", "Love Story", "English"),
        ("CHAD", "Storm", "Klingon"),
        ("PERU", "Glove", "English"),
        ("PERU", "Love Story", "English"),
    ]
    for bad in (None, []):
        with pytest.raises(ValueError):
            rental.popular_by_country(tables.rentals_by_country(), tables.films_with_language(), bad)


def test_films_in_stock(tables):
    def listed(pattern, **options):
        return rental.films_in_stock(
            tables.inventory, tables.films_with_language(), tables.rental, tables.customer, pattern, **options
        )

    # Copy 2 is out; copy 4 has never been rented; copy 1 shows both its rentals.
    assert rows(listed(" %LOVE% ").orderBy("row_num")) == [
        (1, "Love Story", "English", 1, "Ann Lee", T(2017, 1, 1)),
        (2, "Love Story", "English", 1, "Bob ", T(2017, 2, 1)),
        (3, "Love Story", "English", 4, " ", None),
    ]
    with pytest.raises(LookupError):
        listed("%glove")
    assert rows(listed("%glove", must_match=False)) == []
    with pytest.raises(ValueError):
        listed("  ")


@pytest.mark.parametrize("days, fee", [(2, "4.99"), (3, "4.99"), (4, "5.99"), (9, "10.99"), (10, "19.99")])
def test_late_fee(frame, days, fee):
    df = frame("d int", (days,))
    charged = rental.late_fee(F.col("d"), F.lit(3), F.lit("4.99").cast("decimal(4,2)"), F.lit("19.99").cast("decimal(5,2)"))
    assert str(df.select(charged).first()[0]) == fee


def test_rental_charges(tables):
    rentals = tables.rental.join(tables.inventory.select("inventory_id", "film_id"), "inventory_id")
    got = rental.rental_charges(rentals, tables.film).filter("return_date is not null")
    assert [(r[0], r[1], str(r[2])) for r in row_set(got, "rental_id", "days", "amount")] == [
        (1, 2, "4.99"),
        (2, 8, "9.99"),
        (4, 18, "14.99"),
    ]


def test_heavy_customers_count_each_child_alone(frame):
    rentals = frame("customer_id int, rental_id int", (1, 1), (1, 2), (1, 2), (2, 3))
    payments = frame("customer_id int, payment_id int", (1, 1), (1, 2), (1, 3), (2, 4), (2, 5))
    assert row_set(rental.heavy_customers(rentals, payments, 2, 2)) == [(1, 2, 3)]
    assert rows(rental.any_customer(rental.heavy_customers(rentals, payments, 1, 2))) == [(1,)]


def test_customer_with_history(tables):
    got = rental.customer_with_history(tables.customer, tables.rental, tables.payment, "Ann", "Lee")
    assert rows(got) == [("Ann", "Lee", 1)]
    assert rows(rental.customer_with_history(tables.customer, tables.rental, tables.payment, "No", "One")) == []


def test_rent_titles(tables):
    got = rental.rent_titles(tables.inventory, tables.film, tables.staff, 7, ["Love Story"], dt.date(2017, 1, 30))
    assert row_set(got, "inventory_id", "staff_id", "customer_id", "return_date") == [
        (1, 1, 7, dt.date(2017, 2, 6)),
        (4, 2, 7, dt.date(2017, 2, 6)),
    ]
    nobody = tables.customer.filter("customer_id = 99").select("customer_id").scalar()
    assert rental.rent_titles(tables.inventory, tables.film, tables.staff, nobody, ["Love Story"]).count() == 0


def test_row_visibility(tables, frame):
    people = frame("customer_id int, first_name string, last_name string", (3, "Ann", "Lee"), (1, "Ann", "Lee"))
    grant = entitle(people, "Ann", "Lee")
    assert rows(grant) == [("client_ann_lee", 1)]
    assert row_set(visible_rows(tables.rental, grant, "client_ann_lee"), "rental_id") == [(1,), (3,)]
    assert visible_rows(tables.rental, grant, "client_other").count() == 0
    assert rows_per_user(tables.payment, grant).count() == 2
    assert rows(entitle(people, "No", "One")) == []


# -- validated insert ------------------------------------------------------------

FILM = [(5, "Old One"), (9, "Other")]
LANGUAGES = [(1, "English"), (2, "Klingon")]


def enter_one_by_one(batch):
    """The row-at-a-time rule, to compare with."""
    taken = {t.upper() for _, t in FILM}
    known = {n.upper() for _, n in LANGUAGES}
    last, result = max(i for i, _ in FILM), {}
    for seq, title, language in sorted(batch):
        if title is None or not title.strip(" "):
            result[seq] = "title is empty"
        elif title.upper() in taken:
            result[seq] = "title exists"
        elif language is None or language.upper() not in known:
            result[seq] = "unknown language"
        else:
            last += 1
            taken.add(title.upper())
            result[seq] = last
    return result


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(1, 10**6),
            st.sampled_from(["New", "NEW", "Next", "old one", " ", None, "Third"]),
            st.sampled_from(["English", "klingon", "Elvish", None]),
        ),
        min_size=1,
        max_size=12,
        unique_by=lambda r: r[0],
    )
)
def test_new_films_follow_the_row_rule(spark, batch):
    film = spark.createDataFrame(FILM, "film_id int, title string")
    language = spark.createDataFrame(LANGUAGES, "language_id int, name string")
    inserted, refused = rental.new_films(film, language, spark.createDataFrame(batch, "seq int, title string, language string"))
    got = {r.seq: r.film_id for r in inserted.collect()} | {r.seq: r.reason for r in refused.collect()}
    assert got == enter_one_by_one(batch)


def test_new_film_defaults(frame):
    film = frame("film_id int, title string")
    language = frame("language_id int, name string", *LANGUAGES)
    inserted, refused = rental.new_films(film, language, frame("seq int, title string", (1, "Only")), dt.date(2024, 3, 1))
    assert refused.count() == 0
    assert [tuple(map(str, r)) for r in inserted.collect()] == [
        ("1", "Only", "2024", "2", "3", "4.99", "19.99", "2024-03-01", "1")
    ]


def test_take_over_customer(tables):
    person = {"first_name": F.lit("Eve"), "last_name": F.lit("Dale")}
    after = rental.take_over_customer(tables, person, ["Love Story"], dt.date(2017, 1, 20), 2, 2)
    assert row_set(after["customer"], "customer_id", "first_name") == [(1, "Eve"), (2, "Bob")]
    # Customer 1 loses rentals 1 and 3; both copies of the title are rented anew.
    assert row_set(after["rental"], "rental_id", "inventory_id", "customer_id", "staff_id") == [
        (2, 1, 2, 1),
        (4, 3, 2, 2),
        (5, 1, 1, 1),
        (6, 4, 1, 2),
    ]
    paid = after["payment"].filter("payment_date = '2017-01-20'")
    # Seven days on a three-day film: the rate and four days more.
    assert [(r[0], r[1], str(r[2])) for r in row_set(paid, "payment_id", "rental_id", "amount")] == [
        (6, 5, "8.99"),
        (7, 6, "8.99"),
    ]
    assert row_set(after["payment"].filter("payment_id < 6"), "payment_id") == [(2,), (4,), (5,)]


def test_take_over_without_a_heavy_customer_changes_nothing(tables):
    after = rental.take_over_customer(tables, {"first_name": F.lit("Eve")}, ["Love Story"])
    for name in ("customer", "rental", "payment"):
        assert row_set(after[name]) == row_set(getattr(tables, name))
