"""Rows that every operator has to bear."""

#: Ids and texts with nulls, blanks, ties and repeated rows.
ODD = [(None, None), (None, "x"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (4, "two words"), (5, "Ünïcode ÄÖ 42 <|im_end|>"), (6, "a\x00b c")]
