from citewise.operators import max_count, tickets_per_officer, with_max
from citewise.plans import top_officers, top_officers_strict
from helpers import people, rows, ticket, tickets

OFFICER, OTHER = "Police Officer", "Baker"


def test_count_skips_null_ids_and_keeps_null_officers(spark):
    frame = tickets(
        spark, ticket("a", 1), ticket(None, 1), ticket("b", None), ticket(None, 2)
    )
    assert rows(tickets_per_officer(frame)) == [(1, 1), (2, 0), (None, 1)]


def test_ties_are_kept(spark):
    staff = people(spark, (1, "Ann", "A", OFFICER), (2, "Bob", "B", OFFICER), (3, "Cy", "C", OFFICER))
    frame = tickets(
        spark, *[ticket(f"{o}{i}", o) for o in (1, 2) for i in range(3)], ticket("z", 3)
    )
    expected = [(1, "Ann", "A", 3), (2, "Bob", "B", 3)]
    assert rows(top_officers(staff, frame)) == expected
    assert rows(top_officers_strict(staff, frame)) == expected


def test_leader_who_is_no_officer(spark):
    staff = people(spark, (1, "Ann", "A", OFFICER), (2, "Bob", "B", OTHER))
    frame = tickets(spark, ticket("a", 1), ticket("b", 2), ticket("c", 2))
    assert rows(top_officers(staff, frame)) == []
    assert rows(top_officers_strict(staff, frame)) == [(1, "Ann", "A", 1)]


def test_null_officer_may_lead_and_matches_nobody(spark):
    staff = people(spark, (1, "Ann", "A", OFFICER), (None, "No", "Id", OFFICER))
    frame = tickets(spark, ticket("a", 1), ticket("b", None), ticket("c", None))
    assert rows(top_officers(staff, frame)) == []
    assert rows(top_officers_strict(staff, frame)) == [(1, "Ann", "A", 1)]


def test_person_listed_twice_is_named_twice(spark):
    staff = people(spark, (1, "Ann", "A", OFFICER), (1, "Anne", "A", OFFICER))
    frame = tickets(spark, ticket("a", 1))
    expected = [(1, "Ann", "A", 1), (1, "Anne", "A", 1)]
    assert rows(top_officers(staff, frame)) == expected
    assert rows(top_officers_strict(staff, frame)) == expected


def test_no_tickets(spark):
    staff, none = people(spark, (1, "Ann", "A", OFFICER)), tickets(spark)
    assert rows(top_officers(staff, none)) == []
    assert rows(max_count(tickets_per_officer(none))) == [(None,)]
    assert rows(with_max(tickets_per_officer(none))) == []
