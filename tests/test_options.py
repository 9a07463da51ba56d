import pytest

from drivesync import options


@pytest.mark.parametrize("size", [1, 2000])
def test_page_size_in_range(size):
    assert options.check_page_size(size) == size


@pytest.mark.parametrize("size", [0, 2001, -1])
def test_page_size_out_of_range(size):
    with pytest.raises(ValueError):
        options.check_page_size(size)


@pytest.mark.parametrize("size", [0, -5, 4 * 1024 * 1024 + 1])
def test_chunk_size_refused(size):
    with pytest.raises(ValueError):
        options.check_chunk_size(size)


def test_source_options():
    good = options.SourceOptions()
    assert good.chunk_size == 3_932_160 and good.max_entries_per_batch == 1000
    with pytest.raises(ValueError):
        options.SourceOptions(max_entries_per_batch=0)
    with pytest.raises(ValueError):
        options.SourceOptions(chunk_size=0)
    with pytest.raises(ValueError):
        options.SourceOptions(path="relative")
