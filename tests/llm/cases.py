"""Rows that the tests of all operators share."""

SMALL = "/root/testdata/sf0.001"
#: Null, empty, blank, short, odd and repeated texts.
ODD_TEXTS = [None, "", " \n\t ", "a", "a", "Word", "two  words", "x" * 5000, "é ß 漢字 \U0001f600", "<|endoftext|> <p>&amp;", "%%% ### 123"]
