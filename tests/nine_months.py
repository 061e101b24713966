"""Known sales of nine monthly batches, and the figures that belong to them."""

# The figures below belong to exactly these sales
# (order date, store, customer, product, quantity, unit price, total, batch).
SALES = [
    ("2026-01-03", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-01-01"),
    ("2026-01-15", "Y002", "CUST001", "PRD002", 2, 75000, 150000, "2026-01-01"),
    ("2026-01-05", "Y001", "CUST002", "PRD001", 3, 50000, 150000, "2026-01-01"),
    ("2026-01-18", "Y003", "CUST002", "PRD003", 1, 120000, 120000, "2026-01-01"),
    ("2026-01-07", "Y002", "CUST003", "PRD003", 2, 120000, 240000, "2026-01-01"),
    ("2026-01-20", "Y003", "CUST003", "PRD002", 1, 75000, 75000, "2026-01-01"),
    ("2026-01-08", "Y003", "CUST004", "PRD004", 4, 30000, 120000, "2026-01-01"),
    ("2026-01-10", "Y004", "CUST005", "PRD003", 1, 120000, 120000, "2026-01-01"),
    ("2026-01-22", "Y004", "CUST005", "PRD002", 2, 75000, 150000, "2026-01-01"),
    ("2026-01-12", "Y004", "CUST006", "PRD001", 4, 50000, 200000, "2026-01-01"),
    ("2026-01-13", "Y005", "CUST007", "PRD003", 2, 120000, 240000, "2026-01-01"),
    ("2026-01-14", "Y005", "CUST008", "PRD002", 2, 75000, 150000, "2026-01-01"),
    ("2026-01-16", "Y001", "CUST009", "PRD004", 5, 30000, 150000, "2026-01-01"),
    ("2026-01-27", "Y002", "CUST009", "PRD003", 1, 120000, 120000, "2026-01-01"),
    ("2026-01-18", "Y003", "CUST010", "PRD001", 2, 50000, 100000, "2026-01-01"),
    ("2026-01-19", "Y004", "CUST011", "PRD002", 3, 75000, 225000, "2026-01-01"),
    ("2026-01-28", "Y005", "CUST011", "PRD003", 1, 120000, 120000, "2026-01-01"),
    ("2026-01-21", "Y005", "CUST012", "PRD002", 2, 75000, 150000, "2026-01-01"),
    ("2026-02-03", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-02-01"),
    ("2026-02-20", "Y002", "CUST001", "PRD001", 2, 50000, 100000, "2026-02-01"),
    ("2026-02-05", "Y002", "CUST002", "PRD002", 2, 75000, 150000, "2026-02-01"),
    ("2026-02-07", "Y003", "CUST003", "PRD003", 1, 120000, 120000, "2026-02-01"),
    ("2026-02-10", "Y003", "CUST004", "PRD002", 2, 75000, 150000, "2026-02-01"),
    ("2026-02-12", "Y004", "CUST005", "PRD001", 3, 50000, 150000, "2026-02-01"),
    ("2026-02-15", "Y004", "CUST006", "PRD003", 1, 120000, 120000, "2026-02-01"),
    ("2026-02-04", "Y005", "CUST013", "PRD003", 2, 120000, 240000, "2026-02-01"),
    ("2026-02-25", "Y001", "CUST013", "PRD002", 1, 75000, 75000, "2026-02-01"),
    ("2026-02-06", "Y001", "CUST014", "PRD004", 4, 30000, 120000, "2026-02-01"),
    ("2026-02-08", "Y002", "CUST015", "PRD003", 1, 120000, 120000, "2026-02-01"),
    ("2026-02-11", "Y003", "CUST016", "PRD001", 2, 50000, 100000, "2026-02-01"),
    ("2026-02-14", "Y004", "CUST017", "PRD002", 2, 75000, 150000, "2026-02-01"),
    ("2026-02-17", "Y005", "CUST018", "PRD003", 1, 120000, 120000, "2026-02-01"),
    ("2026-02-19", "Y005", "CUST019", "PRD004", 5, 30000, 150000, "2026-02-01"),
    ("2026-02-21", "Y001", "CUST020", "PRD002", 1, 75000, 75000, "2026-02-01"),
    ("2026-03-03", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-03-01"),
    ("2026-03-22", "Y003", "CUST001", "PRD002", 2, 75000, 150000, "2026-03-01"),
    ("2026-03-05", "Y002", "CUST002", "PRD001", 3, 50000, 150000, "2026-03-01"),
    ("2026-03-07", "Y002", "CUST003", "PRD003", 1, 120000, 120000, "2026-03-01"),
    ("2026-03-10", "Y003", "CUST004", "PRD002", 2, 75000, 150000, "2026-03-01"),
    ("2026-03-12", "Y004", "CUST005", "PRD003", 2, 120000, 240000, "2026-03-01"),
    ("2026-03-15", "Y004", "CUST006", "PRD001", 2, 50000, 100000, "2026-03-01"),
    ("2026-03-08", "Y005", "CUST007", "PRD004", 4, 30000, 120000, "2026-03-01"),
    ("2026-03-18", "Y001", "CUST009", "PRD002", 2, 75000, 150000, "2026-03-01"),
    ("2026-03-04", "Y005", "CUST013", "PRD003", 1, 120000, 120000, "2026-03-01"),
    ("2026-03-06", "Y002", "CUST014", "PRD004", 5, 30000, 150000, "2026-03-01"),
    ("2026-03-03", "Y001", "CUST021", "PRD003", 2, 120000, 240000, "2026-03-01"),
    ("2026-03-09", "Y003", "CUST022", "PRD002", 3, 75000, 225000, "2026-03-01"),
    ("2026-03-11", "Y004", "CUST023", "PRD003", 1, 120000, 120000, "2026-03-01"),
    ("2026-03-13", "Y005", "CUST024", "PRD001", 2, 50000, 100000, "2026-03-01"),
    ("2026-03-16", "Y001", "CUST025", "PRD004", 4, 30000, 120000, "2026-03-01"),
    ("2026-03-20", "Y002", "CUST026", "PRD002", 1, 75000, 75000, "2026-03-01"),
    ("2026-03-23", "Y003", "CUST027", "PRD003", 1, 120000, 120000, "2026-03-01"),
    ("2026-04-02", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-04-01"),
    ("2026-04-20", "Y002", "CUST001", "PRD001", 2, 50000, 100000, "2026-04-01"),
    ("2026-04-05", "Y002", "CUST002", "PRD002", 2, 75000, 150000, "2026-04-01"),
    ("2026-04-07", "Y003", "CUST003", "PRD003", 1, 120000, 120000, "2026-04-01"),
    ("2026-04-09", "Y003", "CUST004", "PRD004", 4, 30000, 120000, "2026-04-01"),
    ("2026-04-11", "Y004", "CUST005", "PRD002", 3, 75000, 225000, "2026-04-01"),
    ("2026-04-04", "Y005", "CUST008", "PRD001", 3, 50000, 150000, "2026-04-01"),
    ("2026-04-06", "Y005", "CUST013", "PRD003", 2, 120000, 240000, "2026-04-01"),
    ("2026-04-08", "Y001", "CUST014", "PRD002", 1, 75000, 75000, "2026-04-01"),
    ("2026-04-10", "Y001", "CUST015", "PRD004", 5, 30000, 150000, "2026-04-01"),
    ("2026-04-12", "Y002", "CUST016", "PRD001", 2, 50000, 100000, "2026-04-01"),
    ("2026-04-14", "Y003", "CUST021", "PRD003", 1, 120000, 120000, "2026-04-01"),
    ("2026-04-16", "Y004", "CUST022", "PRD002", 2, 75000, 150000, "2026-04-01"),
    ("2026-04-18", "Y004", "CUST023", "PRD001", 3, 50000, 150000, "2026-04-01"),
    ("2026-04-03", "Y005", "CUST028", "PRD003", 2, 120000, 240000, "2026-04-01"),
    ("2026-04-05", "Y001", "CUST029", "PRD002", 2, 75000, 150000, "2026-04-01"),
    ("2026-04-07", "Y002", "CUST030", "PRD004", 4, 30000, 120000, "2026-04-01"),
    ("2026-04-09", "Y003", "CUST031", "PRD001", 3, 50000, 150000, "2026-04-01"),
    ("2026-04-11", "Y004", "CUST032", "PRD003", 1, 120000, 120000, "2026-04-01"),
    ("2026-04-13", "Y005", "CUST033", "PRD002", 1, 75000, 75000, "2026-04-01"),
    ("2026-05-03", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-05-01"),
    ("2026-05-22", "Y003", "CUST001", "PRD002", 1, 75000, 75000, "2026-05-01"),
    ("2026-05-05", "Y002", "CUST002", "PRD001", 3, 50000, 150000, "2026-05-01"),
    ("2026-05-07", "Y002", "CUST003", "PRD003", 1, 120000, 120000, "2026-05-01"),
    ("2026-05-09", "Y003", "CUST004", "PRD002", 2, 75000, 150000, "2026-05-01"),
    ("2026-05-11", "Y004", "CUST005", "PRD004", 5, 30000, 150000, "2026-05-01"),
    ("2026-05-04", "Y004", "CUST006", "PRD003", 1, 120000, 120000, "2026-05-01"),
    ("2026-05-06", "Y005", "CUST013", "PRD002", 2, 75000, 150000, "2026-05-01"),
    ("2026-05-08", "Y001", "CUST014", "PRD001", 2, 50000, 100000, "2026-05-01"),
    ("2026-05-10", "Y002", "CUST021", "PRD003", 2, 120000, 240000, "2026-05-01"),
    ("2026-05-12", "Y003", "CUST022", "PRD002", 2, 75000, 150000, "2026-05-01"),
    ("2026-05-02", "Y004", "CUST024", "PRD004", 3, 30000, 90000, "2026-05-01"),
    ("2026-05-14", "Y005", "CUST028", "PRD003", 1, 120000, 120000, "2026-05-01"),
    ("2026-05-16", "Y001", "CUST029", "PRD002", 1, 75000, 75000, "2026-05-01"),
    ("2026-05-03", "Y002", "CUST034", "PRD003", 2, 120000, 240000, "2026-05-01"),
    ("2026-05-05", "Y003", "CUST035", "PRD001", 3, 50000, 150000, "2026-05-01"),
    ("2026-05-07", "Y004", "CUST036", "PRD002", 2, 75000, 150000, "2026-05-01"),
    ("2026-05-09", "Y005", "CUST037", "PRD004", 4, 30000, 120000, "2026-05-01"),
    ("2026-05-11", "Y005", "CUST038", "PRD003", 1, 120000, 120000, "2026-05-01"),
    ("2026-06-02", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-06-01"),
    ("2026-06-04", "Y001", "CUST002", "PRD002", 2, 75000, 150000, "2026-06-01"),
    ("2026-06-06", "Y002", "CUST003", "PRD003", 1, 120000, 120000, "2026-06-01"),
    ("2026-06-08", "Y002", "CUST004", "PRD004", 4, 30000, 120000, "2026-06-01"),
    ("2026-06-10", "Y003", "CUST005", "PRD002", 3, 75000, 225000, "2026-06-01"),
    ("2026-06-12", "Y003", "CUST006", "PRD001", 3, 50000, 150000, "2026-06-01"),
    ("2026-06-04", "Y004", "CUST007", "PRD003", 2, 120000, 240000, "2026-06-01"),
    ("2026-06-07", "Y004", "CUST009", "PRD002", 2, 75000, 150000, "2026-06-01"),
    ("2026-06-09", "Y005", "CUST013", "PRD003", 1, 120000, 120000, "2026-06-01"),
    ("2026-06-11", "Y001", "CUST014", "PRD001", 3, 50000, 150000, "2026-06-01"),
    ("2026-06-05", "Y002", "CUST015", "PRD004", 5, 30000, 150000, "2026-06-01"),
    ("2026-06-13", "Y003", "CUST021", "PRD003", 2, 120000, 240000, "2026-06-01"),
    ("2026-06-15", "Y003", "CUST022", "PRD002", 2, 75000, 150000, "2026-06-01"),
    ("2026-06-08", "Y004", "CUST023", "PRD001", 2, 50000, 100000, "2026-06-01"),
    ("2026-06-17", "Y004", "CUST028", "PRD003", 1, 120000, 120000, "2026-06-01"),
    ("2026-06-14", "Y005", "CUST034", "PRD002", 2, 75000, 150000, "2026-06-01"),
    ("2026-06-01", "Y001", "CUST039", "PRD003", 2, 120000, 240000, "2026-06-01"),
    ("2026-06-03", "Y001", "CUST040", "PRD001", 3, 50000, 150000, "2026-06-01"),
    ("2026-06-05", "Y002", "CUST041", "PRD003", 1, 120000, 120000, "2026-06-01"),
    ("2026-06-07", "Y002", "CUST042", "PRD002", 2, 75000, 150000, "2026-06-01"),
    ("2026-06-09", "Y003", "CUST043", "PRD004", 4, 30000, 120000, "2026-06-01"),
    ("2026-06-11", "Y003", "CUST044", "PRD001", 2, 50000, 100000, "2026-06-01"),
    ("2026-06-16", "Y004", "CUST045", "PRD003", 2, 120000, 240000, "2026-06-01"),
    ("2026-06-18", "Y005", "CUST046", "PRD002", 1, 75000, 75000, "2026-06-01"),
    ("2026-07-03", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-07-01"),
    ("2026-07-21", "Y002", "CUST001", "PRD002", 2, 75000, 150000, "2026-07-01"),
    ("2026-07-05", "Y002", "CUST002", "PRD003", 1, 120000, 120000, "2026-07-01"),
    ("2026-07-07", "Y003", "CUST003", "PRD001", 3, 50000, 150000, "2026-07-01"),
    ("2026-07-09", "Y003", "CUST004", "PRD002", 2, 75000, 150000, "2026-07-01"),
    ("2026-07-11", "Y004", "CUST005", "PRD003", 2, 120000, 240000, "2026-07-01"),
    ("2026-07-06", "Y004", "CUST006", "PRD004", 5, 30000, 150000, "2026-07-01"),
    ("2026-07-04", "Y005", "CUST008", "PRD003", 1, 120000, 120000, "2026-07-01"),
    ("2026-07-08", "Y005", "CUST013", "PRD002", 2, 75000, 150000, "2026-07-01"),
    ("2026-07-10", "Y001", "CUST014", "PRD001", 2, 50000, 100000, "2026-07-01"),
    ("2026-07-12", "Y001", "CUST021", "PRD003", 2, 120000, 240000, "2026-07-01"),
    ("2026-07-14", "Y002", "CUST022", "PRD002", 3, 75000, 225000, "2026-07-01"),
    ("2026-07-05", "Y003", "CUST024", "PRD003", 1, 120000, 120000, "2026-07-01"),
    ("2026-07-16", "Y003", "CUST028", "PRD001", 3, 50000, 150000, "2026-07-01"),
    ("2026-07-13", "Y004", "CUST034", "PRD002", 2, 75000, 150000, "2026-07-01"),
    ("2026-07-15", "Y004", "CUST039", "PRD003", 2, 120000, 240000, "2026-07-01"),
    ("2026-07-07", "Y005", "CUST040", "PRD001", 4, 50000, 200000, "2026-07-01"),
    ("2026-07-09", "Y005", "CUST041", "PRD002", 2, 75000, 150000, "2026-07-01"),
    ("2026-07-11", "Y001", "CUST042", "PRD003", 1, 120000, 120000, "2026-07-01"),
    ("2026-07-02", "Y002", "CUST047", "PRD003", 2, 120000, 240000, "2026-07-01"),
    ("2026-07-04", "Y002", "CUST048", "PRD002", 3, 75000, 225000, "2026-07-01"),
    ("2026-07-06", "Y003", "CUST049", "PRD001", 2, 50000, 100000, "2026-07-01"),
    ("2026-07-08", "Y004", "CUST050", "PRD004", 5, 30000, 150000, "2026-07-01"),
    ("2026-07-10", "Y004", "CUST051", "PRD003", 1, 120000, 120000, "2026-07-01"),
    ("2026-07-12", "Y005", "CUST052", "PRD002", 2, 75000, 150000, "2026-07-01"),
    ("2026-07-14", "Y005", "CUST053", "PRD001", 3, 50000, 150000, "2026-07-01"),
    ("2026-08-04", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-08-01"),
    ("2026-08-06", "Y001", "CUST002", "PRD002", 2, 75000, 150000, "2026-08-01"),
    ("2026-08-08", "Y002", "CUST003", "PRD003", 1, 120000, 120000, "2026-08-01"),
    ("2026-08-10", "Y002", "CUST004", "PRD004", 4, 30000, 120000, "2026-08-01"),
    ("2026-08-12", "Y003", "CUST005", "PRD002", 3, 75000, 225000, "2026-08-01"),
    ("2026-08-05", "Y003", "CUST006", "PRD003", 2, 120000, 240000, "2026-08-01"),
    ("2026-08-07", "Y004", "CUST013", "PRD001", 3, 50000, 150000, "2026-08-01"),
    ("2026-08-09", "Y004", "CUST014", "PRD002", 2, 75000, 150000, "2026-08-01"),
    ("2026-08-11", "Y005", "CUST021", "PRD003", 2, 120000, 240000, "2026-08-01"),
    ("2026-08-13", "Y005", "CUST022", "PRD002", 3, 75000, 225000, "2026-08-01"),
    ("2026-08-03", "Y001", "CUST028", "PRD003", 1, 120000, 120000, "2026-08-01"),
    ("2026-08-02", "Y001", "CUST029", "PRD001", 4, 50000, 200000, "2026-08-01"),
    ("2026-08-15", "Y002", "CUST034", "PRD002", 2, 75000, 150000, "2026-08-01"),
    ("2026-08-04", "Y002", "CUST035", "PRD003", 1, 120000, 120000, "2026-08-01"),
    ("2026-08-17", "Y003", "CUST039", "PRD001", 2, 50000, 100000, "2026-08-01"),
    ("2026-08-06", "Y003", "CUST047", "PRD003", 2, 120000, 240000, "2026-08-01"),
    ("2026-08-19", "Y004", "CUST048", "PRD002", 2, 75000, 150000, "2026-08-01"),
    ("2026-08-08", "Y005", "CUST049", "PRD001", 3, 50000, 150000, "2026-08-01"),
    ("2026-08-01", "Y001", "CUST054", "PRD003", 2, 120000, 240000, "2026-08-01"),
    ("2026-08-03", "Y002", "CUST055", "PRD002", 2, 75000, 150000, "2026-08-01"),
    ("2026-08-05", "Y003", "CUST056", "PRD004", 5, 30000, 150000, "2026-08-01"),
    ("2026-08-07", "Y004", "CUST057", "PRD001", 3, 50000, 150000, "2026-08-01"),
    ("2026-08-09", "Y004", "CUST058", "PRD003", 1, 120000, 120000, "2026-08-01"),
    ("2026-08-11", "Y005", "CUST059", "PRD002", 2, 75000, 150000, "2026-08-01"),
    ("2026-09-03", "Y001", "CUST001", "PRD003", 2, 120000, 240000, "2026-09-01"),
    ("2026-09-22", "Y002", "CUST001", "PRD002", 2, 75000, 150000, "2026-09-01"),
    ("2026-09-05", "Y001", "CUST002", "PRD003", 1, 120000, 120000, "2026-09-01"),
    ("2026-09-07", "Y002", "CUST003", "PRD001", 3, 50000, 150000, "2026-09-01"),
    ("2026-09-09", "Y002", "CUST004", "PRD002", 2, 75000, 150000, "2026-09-01"),
    ("2026-09-11", "Y003", "CUST005", "PRD003", 2, 120000, 240000, "2026-09-01"),
    ("2026-09-04", "Y003", "CUST006", "PRD004", 4, 30000, 120000, "2026-09-01"),
    ("2026-09-06", "Y004", "CUST008", "PRD003", 1, 120000, 120000, "2026-09-01"),
    ("2026-09-08", "Y004", "CUST009", "PRD002", 2, 75000, 150000, "2026-09-01"),
    ("2026-09-10", "Y005", "CUST013", "PRD003", 2, 120000, 240000, "2026-09-01"),
    ("2026-09-12", "Y001", "CUST014", "PRD001", 3, 50000, 150000, "2026-09-01"),
    ("2026-09-14", "Y001", "CUST021", "PRD002", 2, 75000, 150000, "2026-09-01"),
    ("2026-09-06", "Y002", "CUST022", "PRD003", 2, 120000, 240000, "2026-09-01"),
    ("2026-09-08", "Y003", "CUST024", "PRD001", 2, 50000, 100000, "2026-09-01"),
    ("2026-09-16", "Y003", "CUST028", "PRD002", 3, 75000, 225000, "2026-09-01"),
    ("2026-09-05", "Y004", "CUST034", "PRD003", 1, 120000, 120000, "2026-09-01"),
    ("2026-09-13", "Y004", "CUST039", "PRD001", 4, 50000, 200000, "2026-09-01"),
    ("2026-09-07", "Y005", "CUST040", "PRD002", 2, 75000, 150000, "2026-09-01"),
    ("2026-09-09", "Y005", "CUST042", "PRD003", 1, 120000, 120000, "2026-09-01"),
    ("2026-09-18", "Y001", "CUST047", "PRD002", 2, 75000, 150000, "2026-09-01"),
    ("2026-09-03", "Y002", "CUST054", "PRD003", 2, 120000, 240000, "2026-09-01"),
    ("2026-09-20", "Y002", "CUST055", "PRD001", 3, 50000, 150000, "2026-09-01"),
    ("2026-09-02", "Y003", "CUST060", "PRD003", 2, 120000, 240000, "2026-09-01"),
    ("2026-09-04", "Y003", "CUST061", "PRD002", 2, 75000, 150000, "2026-09-01"),
    ("2026-09-06", "Y004", "CUST062", "PRD001", 3, 50000, 150000, "2026-09-01"),
    ("2026-09-08", "Y005", "CUST063", "PRD004", 5, 30000, 150000, "2026-09-01"),
    ("2026-09-10", "Y005", "CUST064", "PRD003", 1, 120000, 120000, "2026-09-01"),
]

# Fixed values: (month, orders, buyers, new, retained, retention %, revenue, change %, order value, items per order,
# three-month mean, cumulative revenue, revenue of the top three stores, their share %, diversity).
MONTHS = [
    ("2026-01", 18, 12, 12, 0, None, 2820000, None, 156666.67, 2.22, 2820000.0, 2820000, 1895000, 67.2, 0.5745),
    ("2026-02", 16, 14, 8, 6, 50.0, 2180000, -22.7, 136250.0, 2.0, 2500000.0, 5000000, 1440000, 66.06, 0.5596),
    ("2026-03", 18, 17, 7, 8, 57.14, 2690000, 23.39, 149444.44, 2.22, 2563333.33, 7690000, 1890000, 70.26, 0.5539),
    ("2026-04", 20, 19, 6, 10, 58.82, 2945000, 9.48, 147250.0, 2.3, 2605000.0, 10635000, 1965000, 66.72, 0.6333),
    ("2026-05", 19, 18, 5, 11, 57.89, 2710000, -7.98, 142631.58, 2.11, 2781666.67, 13345000, 2295000, 84.69, 0.5572),
    ("2026-06", 24, 24, 8, 12, 66.67, 3770000, 39.11, 157083.33, 2.25, 3141666.67, 17115000, 2765000, 73.34, 0.5544),
    ("2026-07", 26, 25, 7, 16, 66.67, 4300000, 14.06, 165384.62, 2.31, 3593333.33, 21415000, 2930000, 68.14, 0.5814),
    ("2026-08", 24, 24, 6, 16, 64.0, 4050000, -5.81, 168750.0, 2.33, 4040000.0, 25465000, 2670000, 65.93, 0.5852),
    ("2026-09", 27, 26, 5, 16, 66.67, 4485000, 10.74, 166111.11, 2.26, 4278333.33, 29950000, 2965000, 66.11, 0.5452),
]

# Customers per segment on 2026-10-01.
SEGMENTS = {"Champions": 21, "Need Attention": 20, "Loyal": 14, "Promising": 8, "At Risk": 1}
