"""National numbers written without separators are candidates, and what stands before them decides."""

import pytest

from loomgrain.llm import private_data


@pytest.fixture(scope="module")
def model():
    return private_data.train(private_data.written_examples())


@pytest.mark.parametrize("size", range(9, 16))
def test_single_groups_are_candidates(size):
    text = f"x {'5551234567890123'[:size]} y"
    assert ("phone", 2, 2 + size) in private_data.candidates(text)


@pytest.mark.parametrize("size", [8, 16])
def test_other_sizes_are_none(size):
    assert not [span for span in private_data.candidates(f"x {'5' * size} y") if span[0] == "phone"]


@pytest.mark.parametrize("before, number", [
    ("please call ", "5551234567"), ("Tel. ", "0612345678"), ("Mobil ", "01701234567"), ("you can reach us by phone: ", "2125550147"), ("we are there, fax ", "0301234567"),
])
def test_numbers_after_cues_are_found(model, before, number):
    assert private_data.scan_text(f"{before}{number} today", model)[5] == f"phone:{len(before)}:{len(before + number)}"


@pytest.mark.parametrize("text", ["your order 5551234567 of today", "the id 0612345678 was given", "invoice 01701234567 is open", "see serial number 301234567890 there", "we have 5551234567 of them"])
def test_order_and_id_numbers_are_not(model, text):
    assert private_data.scan_text(text, model)[5] == ""
