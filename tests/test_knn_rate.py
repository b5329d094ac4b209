from voltlens.operators.knn import hash_below


def test_rate_of_any_table_size():
    for rows in (20_001, 10 ** 6, 10 ** 12, 10 ** 15):
        share = (hash_below(20_000, rows) + 2 ** 63) / 2 ** 64
        assert abs(share * rows - 20_000) < 1e-6 * 20_000 + 1e-3
    assert hash_below(5, 5) == 2 ** 63 - 1
