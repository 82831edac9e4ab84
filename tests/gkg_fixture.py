"""The eight hand-written record rows (unlisted columns empty, column 2 = 1)."""

ROWS = [
    ("20150219001500-0", "20150219001500", "Alice Bob,12;Type ParentCategory,3;Carol,9;"),
    ("20150219003000-1", "20150219003000", "Alice Bob,5;;World War 2,7"),
    ("20150220000000-2", "20150220000000", None),          # empty AllNames, Extras = x
    ("baddate-3", "baddate", "Zed,1"),
    ("20150219001500-4", "20150219001500", "SHORT"),       # row ends after 3 fields
    ("20150220001500-5", "20150220001500", 'He said "hi,4;Quote" x,3'),
    ("20150220001500-6", "20150220001500", '"Open quote,4'),
    ("20150220001500-7", "20150220001500", 'Sub Type ParentCategory X,1;Alice Bob,2;Quote" x,8'),
]


def line(rec_id, date, names):
    if names == "SHORT":
        return "\t".join([rec_id, date, "1"])
    fields = [""] * 27
    fields[0], fields[1], fields[2] = rec_id, date, "1"
    if names is None:
        fields[26] = "x"
    else:
        fields[23] = names
    return "\t".join(fields)


def write(path):
    with open(path, "w", encoding="utf-8") as f:
        for r in ROWS:
            f.write(line(*r) + "\n")
    return path


EXPECTED_COUNTS = {
    ("2015-02-19", "Alice Bob", 2), ("2015-02-19", "", 1), ("2015-02-19", "Carol", 1),
    ("2015-02-19", "World War ", 1), ("2015-02-20", 'Quote" x', 2),
    ("2015-02-20", '"Open quote', 1), ("2015-02-20", "Alice Bob", 1),
    ("2015-02-20", 'He said "hi', 1), ("2015-02-20", "Sub Type ParentCategory X", 1),
}

EXPECTED_JSON = [
    '{"data":"2015-02-19","result":[{"topic":"Alice Bob","count":2},{"topic":"","count":1},'
    '{"topic":"Carol","count":1},{"topic":"World War ","count":1}]}',
    '{"data":"2015-02-20","result":[{"topic":"Quote\\" x","count":2},{"topic":"\\"Open quote",'
    '"count":1},{"topic":"Alice Bob","count":1},{"topic":"He said \\"hi","count":1},'
    '{"topic":"Sub Type ParentCategory X","count":1}]}',
]
