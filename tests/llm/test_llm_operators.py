"""Tokens, packing, splits and abuse scores: exact round trips, brute force, held-out agreement."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trajecta.llm import abuse, packing, splits, tokens
from trajecta.llm.molecules import MoleculeNames

ENC = tokens.ForcedEncoder(tokens.default_path())
PIECES = ["it's", "'re", "'", " ", "  ", "\n\n", "\t", " ", "　", " ", "é", "日本語", "模型", "ß", "123", "٣", "a", "don't", "!'s", "…", "🙂", "👩‍🔬", "́", "<|endoftext|>", "_", "x9", "\r\n", "\x1f", "\x85", "ﬁ", "Ł", "।"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)), max_size=12).map("".join))
def test_forced_cuts_change_no_id(text):
    text = text.encode("utf-8", "ignore").decode()
    offsets, ids = ENC.column(pa.array([text, None, "", text]))
    assert ids[: offsets[1]].tolist() == ENC.whole(text) == ids[offsets[3] :].tolist()
    assert offsets[1] == offsets[2] == offsets[3]


def test_same_ids_as_the_other_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40)))
        offsets, ids = ENC.column(pa.array([text]))
        assert ids.tolist() == other.encode(text, add_special_tokens=False).ids


def test_cuts_are_never_inside_a_token():
    for token in list(tokens.load_ranks(tokens.default_path()))[::7]:
        if len(token) > 1 and not token.startswith(b" "):
            data = np.frombuffer(token, dtype=np.uint8)
            assert len(tokens.cut_positions(data, ENC.table)) == 0


def test_encode_corpus_on_dirty_tables(spark):
    long = "mean field 模型 " * 20_000
    rows = [(1, "a b", "x", [9]), (2, None, "x", None), (3, "", None, None), (None, "a b", "y", None), (1, "a b", "x", None), (4, long, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, ids array<int>")
    got = {(r.doc_id, len(r.ids)): r.ids for r in tokens.encode_corpus(df).collect()}
    assert got[(2, 0)] == [] == got[(3, 0)] and got[(1, 2)] == ENC.whole("a b") == got[(None, 2)]
    assert got[(4, len(ENC.whole(long)))] == ENC.whole(long)
    assert sorted(r.n_tokens for r in tokens.count_tokens(df).collect()) == sorted(n for _, n in [*got, (1, 2)])
    assert tokens.encode_corpus(df.limit(0)).count() == 0


def histogram(rng, capacity, n):
    out = {}
    for _ in range(n):
        s = min(capacity, 1 + int(rng.expovariate(8 / capacity)))
        out[s] = out.get(s, 0) + 1
    return out


@pytest.mark.parametrize("capacity", [1, 7, 64, 512])
def test_plan_places_every_item_within_capacity(capacity):
    h = histogram(random.Random(capacity), capacity, 3000)
    plan = packing.plan_packing(h, capacity)
    used = np.zeros(plan.containers, dtype=int)
    for size, n in h.items():
        np.add.at(used, plan.container(np.full(n, size), np.arange(n)), size)
    assert used.max() <= capacity and used.min() > 0 and used.sum() == sum(s * n for s, n in h.items())
    assert plan.containers <= 1.02 * used.sum() / capacity + 2


def test_least_squares_explain_a_solvable_histogram():
    sizes, copies = packing.combinations(np.array([2, 3, 5]), 10)
    truth = np.zeros(11)
    for s, k in ((2, 50), (3, 20), (5, 30)):
        truth[s] = k
    x = packing.nnls(sizes, copies, truth, 3000, 1e-9)
    made = np.bincount(sizes.ravel(), (copies * x[:, None]).ravel(), minlength=11)
    made[0] = 0
    assert (x >= 0).all() and np.abs(made - truth).max() < 0.5


def test_pack_splits_only_what_is_too_long(spark):
    sizes = [(1, 25), (2, 10), (3, 0), (4, None), (5, 4), (5, 4), (None, 6), (6, 30), *[(i, 3) for i in range(10, 40)]]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens int").withColumn("size", F.lit("x"))
    rows = packing.pack(df, 10).collect()
    used = {}
    for r in rows:
        used[r.container_id] = used.get(r.container_id, 0) + r["size"]
    assert max(used.values()) <= 10 and sum(used.values()) == sum(n or 0 for _, n in sizes)
    assert sorted((r.piece, r.piece_start, r["size"]) for r in rows if r.doc_id == 1) == [(0, 0, 10), (1, 10, 10), (2, 20, 5)]
    assert sum(r.doc_id == 5 for r in rows) == 2 and sum(r["size"] == 0 for r in rows) == 2
    assert packing.pack(df.limit(0), 10).count() == 0
    assert packing.pack(df.where("coalesce(n_tokens, 0) = 0"), 10).count() == 2
    with pytest.raises(ValueError):
        packing.pack(df, 0)


CATALOGUE = [
    (1, "H2O", ["O", "H", "H"], 0, "water (bent), relaxed by hand"), (2, "HCN", ["H", "C", "N"], 0, "known as prussic acid; linear start geometry"),
    (3, "HNC", ["H", "N", "C"], 0, "Start structure for hydrogen isocyanide, linear"), (4, "CO", ["C", "O"], 0, "usually called carbon monoxide"),
    (5, "NH4+", ["N", "H", "H", "H", "H"], 1, None), (6, "OH-", ["O", "H"], -1, "usually called hydroxide"), (7, "LiH", ["Li", "H"], 0, ""),
]


@pytest.mark.parametrize(("name", "want"), [
    ("H2O", 1), (" h2o\t", 1), ("H₂O", 1), ("H$_2$O", 1), ("O-H-H", 1), ("OHH", 1), ("HOH", 1), ("WATER", 1), ("H_{2}O", 1),
    ("H-C-N", 2), ("NCH", 2), ("CNH", 3), ("Hydrogen  isocyanide", 3), ("co", 4), ("OC", 4), ("[NH4]+", 5), ("NH₄⁺", 5), ("N-H-H-H-H (+)", 5),
    ("OH⁻", 6), ("HO-", 6), ("OH(-)", 6), ("LIH", 7), ("HLi", 7), (None, None), ("", None), ("  ", None), ("XeF2", None), ("OH", 6), ("H" * 5000, None), ("H" + "0" * 90 + "2O", 1), ("h9999999999999o", None), ("h" + "-" * 300 + "h-o", 1), ("conhco" * 40, None),
])
def test_names_however_written(name, want):
    assert MoleculeNames(CATALOGUE).resolve(name) == want


FEATURES = "load_id bigint, experiment_id string, molecule_name string, converged boolean, split string"


def catalogue(spark):
    return spark.createDataFrame(CATALOGUE, "molecule_id int, name string, symbols array<string>, charge int, description string")


def brute_components(rows):
    names, parent = MoleculeNames(CATALOGUE), {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, e, m, *_ in rows:
        keys = [("r", i)]
        if e is not None:
            keys.append(("e", e.strip().lower()))
        if m is not None and m.strip(" "):
            keys.append(("m", names.resolve(m) or m.strip().casefold()))
        for k in keys[1:]:
            parent[root(k)] = root(keys[0])
    groups = {}
    for i, *_ in rows:
        groups.setdefault(root(("r", i)), set()).add(i)
    return sorted(map(sorted, groups.values()))


def test_splits_keep_related_rows_together(spark):
    rng = random.Random(2)
    names = ["H2O", "water", "HCN", "NCH", "HNC", "LiH", "Xyz", None, "", "CO", "co"]
    rows = [(i, rng.choice([f"e{rng.randint(0, 150)}", f" E{rng.randint(0, 150)} ", None]), rng.choice(names), rng.random() < 0.5, None) for i in range(300)]
    rows += [(1000 + i, f"solo{i}", f"thing{i}", None, None) for i in range(400)]
    got = splits.assign_splits(spark.createDataFrame(rows, FEATURES), catalogue(spark)).collect()
    assert sorted(r.load_id for r in got) == sorted(r[0] for r in rows)
    groups, where = {}, {}
    for r in got:
        groups.setdefault(r.component, set()).add(r.load_id)
        where.setdefault(r.component, set()).add(r.split)
    assert sorted(map(sorted, groups.values())) == brute_components(rows)
    assert all(len(s) == 1 for s in where.values())
    assert splits.assign_splits(spark.createDataFrame([], FEATURES), catalogue(spark)).count() == 0


def test_quotas_are_met_when_components_are_small():
    rng = random.Random(4)
    bundles = {(s, c): rng.randint(1, 40) for s in range(1, 30) for c in range(5)}
    out = splits.allocate(bundles)
    total = sum(s * n for (s, _), n in bundles.items())
    rows = [sum(b[0] * g[j] for b, g in out.items()) for j in range(3)]
    assert all(sum(g) == bundles[b] and min(g) >= 0 for b, g in out.items())
    assert all(abs(r - p * total) <= 30 for r, (_, p) in zip(rows, splits.SPLITS, strict=True))
    assert splits.allocate({}) == {} and sum(splits.allocate({(7, 0): 1})[7, 0]) == 1


@pytest.mark.parametrize("n", [1, 399, 401, 4999, 6000])
def test_rounding_is_repaired_at_any_number_of_bundles(n):
    rng = random.Random(n)
    bundles = {(rng.randint(1, 40 * n), rng.randint(0, 4)): 1 for _ in range(n)}
    out = splits.allocate(bundles)
    total = sum(s for s, _ in bundles)
    rows = [sum(b[0] * g[j] for b, g in out.items()) for j in range(3)]
    assert all(sum(g) == bundles[b] and min(g) >= 0 for b, g in out.items()) and sum(rows) == total
    assert n == 1 or all(abs(r - p * total) <= 2 for r, (_, p) in zip(rows, splits.SPLITS, strict=True))


def test_combinations_thinned_for_every_longest_length():
    lengths = np.arange(1, 1200)
    sizes, copies = packing.combinations(lengths, 2000, 20_000)
    assert ((sizes * copies).sum(1) == 2000).all()
    triples = sizes[(copies[:, 2] > 0)]
    assert len(sizes) < 40_000 and set(triples[:, 0]) == set(range(667, 1200)) and len(np.unique(triples, axis=0)) == len(triples)
    whole, _ = packing.combinations(lengths, 2000, 10**9)
    assert len(whole) > 100_000 and set(map(tuple, triples)) <= set(map(tuple, whole))


def test_min_cost_flow_prefers_cheap_arcs():
    arcs = [(0, 1, 5, 0), (1, 2, 3, 0), (1, 2, 5, 2), (2, 3, 4, 0), (2, 3, 9, 1)]
    assert splits.min_cost_flow(arcs, 0, 3) == [5, 3, 2, 4, 1]


@pytest.mark.parametrize("one_task", [100_000, 0])
def test_components_of_chains_stars_and_loops(spark, one_task):
    edges = [(f"a{i}", f"a{i + 1}") for i in range(40)] + [("hub", f"s{i}") for i in range(200)] + [("z", "z"), ("p", "q"), ("q", "p"), (None, "x")]
    got = {r.node: r.label for r in splits.connected(spark.createDataFrame(edges, "a string, b string"), one_task=one_task).collect()}
    assert {got[f"a{i}"] for i in range(41)} == {"a0"} and {got[f"s{i}"] for i in range(200)} | {got["hub"]} == {"hub"}
    assert got["p"] == got["q"] == "p" and got["z"] == "z"


def test_alias_experiments(spark):
    rows = [(1, " E1", "H2O", True, None), (2, "e1", "water", True, None), (3, "e2", "HCN", None, None), (4, None, "water", None, None), (5, "e3", None, None, None), (6, "E1 ", "WATER", None, None)]
    links = splits.entity_links(spark.createDataFrame(rows, FEATURES), splits.catalogue_names(catalogue(spark)))
    assert [tuple(r) for r in splits.alias_experiments(links).collect()] == [("e1", 1)]
    placed, split_of = splits.split_links(spark.createDataFrame(rows, FEATURES), catalogue(spark))
    assert [tuple(r) for r in splits.alias_experiments(placed).collect()] == [("e1", 1)]
    assert placed.where("split is null").count() == 0 and placed.select("component").distinct().count() <= split_of.count()


DISGUISED = [
    "You are a worthless idiot.", "shut up, you d u m b a s s", "You are a cr3t1n!", "You i​diot!", "YOU STUUUUPID M.O.R.O.N", "you are such an idoit", "you idot, go away", "YOU STUPID M0R0N", "f**k you",
    "you " + "idiot" + "t" * 60, "you diiiickheeeead", "Quoted: \"You brainless sh*thead.\"", "you are an аsshоlе", "you lazy m*r*n", "b1tch, get lost", "お前は馬鹿だ、死ね", "去死吧，你这个白痴",
]
HARMLESS = [
    "", None, "   ", "I was an idiot yesterday: the walltime ran out.", "The dumb terminal shows the analysis.", "Kill the worker before you strip the checkpoint.", "Women and immigrants in computing: reading list.",
    "The report quotes no insults; it only counts how often a message was called hateful.", "We need a stopcock, a screw clamp and a cocktail of solvents.", "Boron and neon at a fair price.", "H-C-N and C-H-H-H-H",
    "a*b + c**2", "x" * 200_000, "We kill your process when memory is low", "Nice cock valve on the chiller line", "I hope you lose your job queue entry", "プロセスを再起動してください。", "请重新启动该进程。",
]


def test_abuse_in_any_spelling_by_priors_alone():
    weights = np.append(abuse.features().priors(), np.float32(0))
    assert [t for t, s in zip(DISGUISED, abuse.score_texts(DISGUISED, weights)[:, 0], strict=True) if s < abuse.THRESHOLD] == []
    assert [t[:60] for t, s in zip(HARMLESS, abuse.score_texts(HARMLESS, weights)[:, 0], strict=True) if t and s >= abuse.THRESHOLD] == []


def test_quotation_is_scored_apart():
    weights = np.append(abuse.features().priors(), np.float32(0))
    quoted, own = abuse.score_texts(['They wrote: "you stupid moron".', "you stupid moron"], weights)
    assert quoted[2] >= 0.5 and quoted[1] < 0.5 and own[1] >= 0.5 and own[2] == 0


def test_labels_move_the_weights():
    """Contexts the lexicon knows nothing of are learned from reviewed texts, also against the priors."""
    bad = [f"See page {i}. You are made of cardboard." for i in range(300)]
    fine = [f"See page {i}. You see the idiot light." for i in range(300)]
    weights = abuse.fit_weights([*bad, *fine, None, ""], np.array([1.0] * 300 + [0.0] * 302), np.array([2.0] * 602))
    scores = abuse.score_texts(["so you are made of cardboard", "you see the idiot light again", None], weights)[:, 0]
    assert scores[0] >= 0.5 > scores[1] and scores[2] == 0
    assert (abuse.fit_weights([], np.zeros(0), np.zeros(0)) == np.append(abuse.features().priors(), np.float32(0))).all()


@pytest.fixture(scope="module")
def reviewed(spark):
    base = "/root/testdata/sf0.1"
    return abuse.trained(spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/review_labels.parquet"))


#: Sentences made by hand, none of them from the corpus: language -> (abusive, harmless).
BY_HAND = {
    "en": ("""I will burn your house down tonight|Your whole family deserves to rot|I'm coming to your office with a gun|You disgust me, worthless trash|you pathetic little coward|what a bunch of losers you are|go to hell, bastard
        I swear I will break your legs|somebody should shoot you|immigrants are animals and should be gassed|gays are a disease|all foreigners are parasites|I hate jews|women are too stupid for this, back to the kitchen|send me your nudes
        I want to lick your pussy|your tits look great in that shirt|kill yourself|you filthy whore|shut the fuck up|nobody likes you, you ugly pig|you people are vermin|I hope you die soon|your mother is a whore|rot in hell, you swine""",
        """We kill your process when memory is low|kill yourself-managed cluster|Nice cock valve on the chiller line|I hope you lose your job queue entry|Please send me your notes|You can drop the table after the backup|The women in physics group meets on Monday
        Your house style asks for SI units|shoot me an email if the run dies|the rat brain data set is large|Burn the disk image before you leave|I am such an idiot, I forgot the seed|The word whore was removed by a moderator|This damn printer is broken again
        You should cut the tail of your trajectory|refugees welcome|the parasite terms vanish|Thanks, you saved my day|hit the brakes on that sweep|we execute your script at midnight|your gradient vanishes|Foreigners need a visa form|The knife edge case is covered|beat the baseline and tell us how|my dead node came back"""),
    "de": ("""Du bist so ein Versager|halt deine Fresse|verpiss dich, du Arschloch|ich werde dich umbringen|Ausländer sind Abschaum|du dreckige Schlampe|alle Juden vergasen|du hässlicher Trottel|ich hasse Flüchtlinge|deine Mutter ist eine Hure|zeig mir deine Titten|ich breche dir die Knochen, du Depp""",
        """Der Prozess ist gestorben|ich war ein Trottel und habe den Seed vergessen|Bitte schick mir deine Werte|Frauen in der Physik: Vortrag am Montag|töte den Prozess vor dem Neustart|du hast recht, danke|verdammter Drucker|die Ratten im Versuch sind gesund|Du sollst die Tabelle löschen|Wir verbrennen zu viel Rechenzeit|die Klappe am Ofen klemmt|Ausländer brauchen ein Visum"""),
    "fr": ("""Tu es vraiment une grosse merde|ta gueule, connard|je vais te tuer|les immigrés sont des parasites|sale pute|va te faire foutre|espèce d'abruti, tu es nul|les juifs sont de la vermine|je te déteste, salope|tu es un porc et un idiot|nique ta mère|montre tes seins""",
        """Le processus est mort|J'ai été idiot, j'ai oublié la graine|Merci pour tes données|Les femmes en physique: conférence lundi|il faut tuer le processus avant|tu as raison, merci|La table est vide|Les étrangers ont besoin d'un visa|Sans bruit, la méthode donne -40|tu peux couper la fin de la trajectoire|quelle énergie pour votre molécule?|On brûle trop de temps de calcul"""),
    "es": ("""eres un idiota inútil|cállate, imbécil|te voy a matar|los inmigrantes son ratas|hijo de puta|vete a la mierda|eres una puta asquerosa|ojalá te mueras, cabrón|odio a los judíos|tu madre es una zorra|quiero follarte|las mujeres son tontas, a la cocina""",
        """El proceso murió anoche|fui un idiota, olvidé la semilla|Gracias por tus datos|Mujeres en la física: charla el lunes|hay que matar el proceso antes|tienes razón, gracias|La tabla está vacía|Los extranjeros necesitan visado|puedes cortar el final de la trayectoria|¿cuál es tu energía final?|Quemamos demasiado tiempo de cálculo|el ordenador es lento"""),
    "pl": ("""jesteś idiotą, kretynie|zamknij ryj, debilu|zabiję cię|imigranci to szumowiny|ty kurwo|spierdalaj|twoja matka to dziwka i suka|żydzi to pasożyty|nienawidzę cię, śmieciu|ty głupi palancie|pokaż cycki|wypierdalaj, frajerze""",
        """Proces umarł w nocy|byłem idiotą, zapomniałem ziarna|Dziękuję za twoje dane|Kobiety w fizyce: wykład w poniedziałek|trzeba zabić proces wcześniej|masz rację, dzięki|Tabela jest pusta|Cudzoziemcy potrzebują wizy|możesz obciąć koniec trajektorii|jaka jest twoja energia?|Spalamy za dużo czasu|serwer jest powolny"""),
    "ru": ("""ты идиот, заткнись|я тебя убью|сдохни, тварь|евреи паразиты|ты тупая сука|пошел нахуй|ты жалкий урод|мигранты это отбросы""",
        """процесс умер ночью|я идиот, забыл зерно|спасибо за твои данные|таблица пуста|нужно убить процесс|ты прав, спасибо|женщины в физике: лекция|сервер медленный"""),
}


def test_sentences_made_by_hand(reviewed):
    """Held out: no row of the corpus; the figures of every language are in the README."""
    found = {}
    for lang, sides in BY_HAND.items():
        bad, fine = ([t.strip() for line in side.splitlines() for t in line.split("|")] for side in sides)
        found[lang] = ((abuse.score_texts(bad, reviewed)[:, 0] >= 0.5).sum(), len(bad), (abuse.score_texts(fine, reviewed)[:, 0] >= 0.5).sum(), len(fine))
    print({k: tuple(map(int, v)) for k, v in found.items()})
    hit, n, wrong, m = np.array(list(found.values())).sum(0)
    assert hit >= 0.75 * n and wrong <= 0.1 * m, found


def test_every_word_of_a_spaced_out_run_is_joined():
    r, priors = abuse.reader(), np.append(abuse.features().priors(), np.float32(0))
    words = lambda t: r.unspace(t).split()
    assert words("because of you, f.u.c.k.i.n.g m o r o n that you are") == "because of you, fucking moron that you are".split()
    assert words("f u c k y o u") == ["fuck", "you"] == words("f u c k  y o u") and words("y o u.a.r.e a m o r o n") == "you are a moron".split()
    assert words("h-c-n and c-h-h-h-h") == ["h-c-n", "and", "c-h-h-h-h"]
    assert (abuse.score_texts(["f.u.c.k.i.n.g m o r o n that you are", "f u c k y o u", "F-U-C-K Y-O-U"], priors)[:, 0] >= abuse.THRESHOLD).all()


def test_words_of_any_length_and_null_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot", "a", 1), (2, None, "a", 2), (None, "x", None, 3), (1, "you idiot", "a", 4)], "doc_id bigint, text string, source string, rate int")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (1, 2, None), (None, 1, 1), (9, 1, 0)], "doc_id bigint, reviewer_no int, abusive int").withColumn("reviewed_at", F.lit(None).cast("timestamp"))
    sample = abuse.labelled_sample(docs, labels)
    assert list(zip(sample["rate"], sample["judged"], strict=True)) == [(1.0, 1), (1.0, 1)]
    assert len(abuse.labelled_sample(docs, labels.limit(0))) == 0 == len(abuse.labelled_sample(docs, labels, 0))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    above = None
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            d = min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y))
            if i and j and x == b[j - 1] and a[i - 1] == y:
                d = min(d, above[j - 1] + 1)
            new.append(d)
        above, row = row, new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=5), min_size=1, max_size=8), st.text("abc", max_size=5), st.integers(0, 2))
def test_automaton_finds_the_nearest_entry(words, word, most):
    near = min(((levenshtein(word, w), w) for w in words), default=None)
    assert abuse.Trie(words).near(word, most) == (near if near[0] <= most else None)


def test_rates_per_source(spark):
    rows = [(1, "you stupid moron", "a"), (2, "fine", "a"), (3, None, None), (4, 'he said "you stupid moron"', None), (None, "", "b")]
    scores = abuse.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("score", F.lit("x")))
    assert {tuple(r) for r in abuse.source_rates(scores).collect()} == {("a", 2, 1, 0.5, 0), (None, 2, 1, 0.5, 1), ("b", 1, 0, 0.0, 0)}
    assert sorted(r.doc_id for r in abuse.flagged(scores).collect()) == [1, 4]
    assert abuse.source_rates(scores.limit(0)).count() == 0


def test_too_many_bundles_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(splits, "MAX_BUNDLES", 1)
    base = "/root/testdata/sf0.001"
    with pytest.raises(ValueError, match="bundles"):
        splits.assign_splits(spark.read.parquet(f"{base}/ml_iteration_features.parquet"), spark.read.parquet(f"{base}/molecule_catalog.parquet"))
