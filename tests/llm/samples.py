"""Texts that several tests use."""

#: Nulls, empty, blank, short, equal and odd texts; repeated ids.
ODD = [None, "", " \t\n", "one", "One", "two words", "é", "a\x1cb  c\td", "x" * 3000, "1 2 3 4 5",
       "a.b@c.de a.b@c.de", "The the of.\nThe the of.\nThe the of.", "\U0001f600 <|endoftext|> #*$%&|<>", "\u00b2 \u00bd \u2167 12"]
