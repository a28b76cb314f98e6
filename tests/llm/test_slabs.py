"""How many times a vector travels."""

from spindrift.llm.embeddings import slabs_of


def test_slabs_grow_with_the_table_before_they_multiply():
    assert [slabs_of(n) for n in (0, 1, 4096, 10_256)] == [1, 1, 1, 3]
    assert {slabs_of(n) for n in (51_282, 100_000, 262_144)} == {8}  # five times the vectors, the same copies of each
    assert slabs_of(720_000) == 22 and slabs_of(300, slab_rows=16) == 8
