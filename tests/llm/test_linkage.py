import numpy as np

from kinlattice.llm import linkage

STAGED = "id string, name string, npi string, address_line1 string, city string, state string, zip string, location string, names string"


def test_link(spark):
    t = ("Oskvermoor", "AZ", "44620")
    ops = ["Myrdova Autism Center", "Selsona Pediatric Therapy", "Gridova Early Steps", "Falmora Autism Services", "Hurdrel Behavior Partners", "Grilume Autism Center"]
    staged, centers, want = [], [], set()
    for i, op in enumerate(ops * 6):
        line = f"{100 + i} Elm St"
        a, b, c = op.split(" ")
        forms = [op + ", LLC", f"{b} {c}, {a}".upper(), f"{op} - {t[0]}", op[:3] + op[4:]]
        centers.append((f"rc{i}", op, line, *t))
        other = ops[(i + 1) % len(ops)]
        for k, n in enumerate(forms):
            staged.append((f"s{i}_{k}", n, f"{i}", line, *t, "clash", "clash"))
            want.add((f"s{i}_{k}", f"rc{i}"))
        staged.append((f"s{i}_x", other, f"x{i}", line, *t, "", ""))
        staged.append((f"s{i}_p", "Galia Rastelow", f"p{i}", line, *t, "", ""))
    staged.append(("legal", "Path Operating Partners, LLC", None, "100 Elm Street", *t, "", ""))
    want.add(("legal", "rc0"))
    staged += [("nul", None, None, None, None, None, None, None, None), ("noname", None, None, "100 Elm St", *t, None, None)]
    owners = spark.createDataFrame([("Path Operating Partners, LLC", "Myrdova Autism Center"), ("Lone, Inc", None), (None, None)], "name string, trade_name string")
    got = linkage.link(spark.createDataFrame(staged, STAGED), spark.createDataFrame(centers, "id string, name string, address_line1 string, city string, state string, zip string"), owners)
    assert {(r[0], r[1]) for r in got.where("confidence >= 0.5").collect()} == want


def test_label_model_learns_accuracies_and_copies():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.4
    good = [np.where(rng.random(4000) < 0.95, np.where(y, 1, -1), np.where(y, -1, 1)) for _ in range(3)]
    weak = np.where(rng.random(4000) < 0.55, np.where(y, 1, -1), np.where(y, -1, 1))
    votes = np.stack([*good, weak, weak], 1)  # two copies of one weak function
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = linkage.fit_label_model([(p.tolist(), int(n)) for p, n in zip(patterns, counts)])
    right = np.mean([(model[tuple(v)] >= 0.5) == t for v, t in zip(votes.tolist(), y)])
    assert right > 0.97
    assert linkage.fit_label_model([]) == {}
