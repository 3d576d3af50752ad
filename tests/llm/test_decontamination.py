"""Places where neighbouring texts meet."""

from helpers_llm import text

from pricebars.llm import decontamination


def test_an_item_split_between_neighbouring_texts_is_in_neither():
    item = text(50, 30)
    index = decontamination.index([(1, item)])
    blanks = [i for i, c in enumerate(item) if c == " "]
    for cut in blanks:
        texts = [f"{text(1, 9)} {item[:cut]}", f"{item[cut + 1 :]} {text(2, 9)}"]
        alone = [decontamination.scan([t], index)[0] for t in texts]
        assert decontamination.scan(texts, index) == alone
        if min(cut, len(item) - cut) > len(item) // 10 + 1:
            assert alone == [[], []]


def test_an_item_beside_a_half_of_it_is_found():
    item = text(51, 30)
    index = decontamination.index([(1, item)])
    texts = [item[:-5], item[-4:] + " " + item, item[: len(item) // 2], item[len(item) // 2 :]]
    got = decontamination.scan(texts, index)
    assert [[f["edits"] for f in found] for found in got] == [[5], [0], [], []]
    assert got[0][0]["end"] <= len(texts[0])
