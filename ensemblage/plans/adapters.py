"""The given tables read as ensemble data: every row of theirs becomes a conformer, observable, file or event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ensemblage.session import spread


class Given:
    """The given parquet tables, and the ensemble tables derived from them without a shuffle where possible."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # conformers and thermochemistry: one order is one conformer of its customer's ensemble

    def thermo_in(self) -> DataFrame:
        key, price = F.col("o_orderkey"), F.col("o_totalprice")
        return self.table("orders").select(
            F.col("o_custkey").alias("ensemble_id"),
            (key + 1).alias("conf_idx"),
            F.when(F.col("o_orderstatus") != "P", F.lit(-76.0) - price * F.lit(1e-8)).alias("e_high_eh"),
            (F.lit(0.04) + (key % 7) * F.lit(1e-4)).alias("g_minus_eel_low_eh"),
            F.when(key % 2 == 0, F.lit(-75.96) - price * F.lit(1e-8)).alias("g_low_eh"),
        )

    def conformers(self, all_energies: bool = False) -> DataFrame:
        energy = F.col("o_totalprice") * F.lit(1.0371319e-5)
        if not all_energies:
            energy = F.when(F.col("o_orderstatus") != "P", energy)
        return self.table("orders").select(
            F.col("o_custkey").alias("ensemble_id"), (F.col("o_orderkey") + 1).alias("conf_idx"),
            energy.alias("energy_kcal"),
        )

    # observables: one lineitem is one shielding, one coupling or one atom of its order

    @staticmethod
    def element(flag: str = "l_returnflag") -> Column:
        return F.when(F.col(flag) == "A", "H").when(F.col(flag) == "N", "C").otherwise("O")

    def observed(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("ensemble_id"))
        items = self.table("lineitem").withColumn("conf_idx", F.col("l_orderkey") + 1)
        return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def shieldings(self) -> DataFrame:
        return self.observed().select(
            "ensemble_id", "conf_idx", F.col("l_linenumber").alias("atom_index"), self.element().alias("element"),
            (F.lit(25.0) + F.col("l_extendedprice") * F.lit(1.0371319e-4)).alias("sigma_iso_ppm"),
        )

    def couplings(self) -> DataFrame:
        return self.observed().select(
            "ensemble_id", "conf_idx",
            F.col("l_linenumber").alias("i"), self.element().alias("elem_i"),
            (F.col("l_linenumber") + 1).alias("j"),
            F.when(F.col("l_linestatus") == "O", "H").otherwise("C").alias("elem_j"),
            F.when(F.col("l_tax") < 0.07, F.col("l_quantity") * F.lit(0.30173917131) - 2.0).alias("j_total_hz"),
        )

    # texts: every order and every lineitem is written out as the files of one task

    def job_files(self) -> DataFrame:
        """A frequency run, an energy run and an NMR run per order, each under its own condition."""
        key, price = F.col("o_orderkey"), F.col("o_totalprice")
        e_low, e_high = F.lit(-75.9) - price * F.lit(1e-8), F.lit(-76.0) - price * F.lit(1e-8)
        g_corr = F.lit(0.04) + (key % 7) * F.lit(1e-4)
        end = F.when(F.col("o_orderstatus") == "F", "****ORCA TERMINATED NORMALLY****\n").otherwise("killed\n")
        frequency = F.concat(
            F.format_string("FINAL SINGLE POINT ENERGY     %.12f\n", e_low + F.lit(0.5)),
            F.format_string("FINAL SINGLE POINT ENERGY     %.12f\nTHERMOCHEMISTRY AT T = 298.15 K\n", e_low),
            F.format_string("Total enthalpy      ...   %.12f Eh\n", e_low + F.lit(0.05)),
            F.lit("Total entropy correction     ...  -0.010000000000 Eh\n"),
            F.format_string("Final Gibbs free energy   ...  %.12f Eh\n", e_low + g_corr),
            F.format_string("G-E(el)     ...  %.12f Eh  26.3 kcal/mol\n", g_corr), end,
        )
        energy = F.concat(F.format_string("SCF done\r\nFINAL SINGLE POINT ENERGY     %.12f\r\n", e_high), end)
        wrong = F.concat(F.lit("FINAL SINGLE POINT ENERGY     -99.000000000000\n"), end)
        priority = F.col("o_orderpriority")

        def file(wanted: Column, name: str, content: Column) -> Column:
            return F.when(wanted, F.struct(F.lit(name).alias("file_name"), content.alias("content")))

        files = F.array_compact(F.array(
            file(F.col("o_orderstatus") != "P", "a_freq.out", frequency),
            file(priority != "5-LOW", "b_sp.out", energy),
            file(priority == "1-URGENT", "orca_nmr_h.out", wrong),
        ))
        return spread(self.table("orders")).select(
            F.col("o_custkey").alias("ensemble_id"), (key + 1).cast("int").alias("task_idx"), F.explode(files).alias("f"),
        ).select("ensemble_id", "task_idx", "f.file_name", "f.content")

    def _item_files(self, content: Column) -> DataFrame:
        name = F.concat_ws("_", F.col("l_partkey"), F.col("l_suppkey"), F.lit("nmr.out"))
        return spread(self.table("lineitem")).select(
            F.col("l_orderkey").alias("ensemble_id"), F.col("l_linenumber").alias("task_idx"), name.alias("file_name"),
            content.alias("content"),
        )

    def shielding_files(self) -> DataFrame:
        """Two summaries per lineitem: an older one, and the final one with three atoms."""
        title = "\n CHEMICAL SHIELDING SUMMARY (ppm)\n ---------\n  Nucleus  Element  Isotropic  Anisotropy\n"
        return self._item_files(F.concat(
            F.lit(title + "  0  C   1.000000   2.000000\n  9  H   9.000000   1.500000\n\n 0 C 5.0 5.0\n"),
            F.lit(title), F.format_string("  0  C   %.6f   12.500\n", F.lit(25.0) + F.col("l_extendedprice") * F.lit(1e-4)),
            F.format_string("  1  H   %.3f   -5.000\n", F.lit(29.0) + F.col("l_quantity") * F.lit(0.1)),
            F.format_string("  2  Cl  -%.2f  1.0e+01\n", F.col("l_discount") + F.lit(1.0)), F.lit(" \nTIMINGS SUMMARY\n 7 H 1.0 1.0\n"),
        ))

    def coupling_files(self) -> DataFrame:
        """Two pair blocks per lineitem, in one of the three header styles."""
        total = F.col("l_quantity") - F.lit(7.25)
        fc, sd = F.col("l_quantity") * F.lit(0.5), F.col("l_discount")
        filler = "  some text\n" * 11
        same_line = F.concat(
            F.lit("   NUCLEUS A = H    9 NUCLEUS B = C    8\n" + filler),
            F.format_string("  J[8,9](Total)      iso=  %.3f\n", total), F.format_string("  J[8,9](FC)  iso=  %.2f\n", fc),
            F.lit("  J[7,9](SD)  iso=   3.000\n"), F.format_string("  J[8,9](SD)  iso=   %.2f\n", sd),
            F.lit("   NUCLEUS A = H    1 NUCLEUS B = H    2\n  J[1,2](Total) iso= 1.5\n"),
        )
        two_lines = F.concat(
            F.lit(" Nucleus A: 0 C\n ----\n Nucleus B: 1 H\n"), F.format_string("Fermi contact contribution  : %.2f Hz\n", fc),
            F.lit("Spin-dipolar/Fermi-contact cross term   :    0.001 Hz\n"),
            F.format_string("Spin-dipolar contribution  : %.2f Hz\n", sd), F.format_string("Total       :  %.3f Hz\n", total),
            F.lit(" Nucleus A: 5 H\n Nucleus B: 4 H\nTotal  :  2.5 Hz\n"),
        )
        comma = F.concat(
            F.lit("NUCLEUS A = 2 H, NUCLEUS B = 3 H\n Total = 99.0\nNUCLEUS A = 2 H, NUCLEUS B = 3 H\n"),
            F.format_string("FC = %.2f\n", fc), F.format_string("SD = %.2f\n", sd), F.lit("PSO = 0.034\nDSO = -0.022\nSD/FC = 0.001\n"),
        )
        flag = F.col("l_returnflag")
        return self._item_files(F.when(flag == "A", same_line).when(flag == "N", two_lines).otherwise(comma))

    def energy_files(self) -> DataFrame:
        content = F.concat(
            F.format_string("1 -1.234 %.2f\n", F.col("o_totalprice")), F.lit("NA\n\n# header\n"),
            F.format_string("2, -1.5, %d\n   NaN\n", F.col("o_orderkey")),
        )
        return spread(self.table("orders")).select("o_orderkey", content.alias("content"))

    def frame_files(self) -> DataFrame:
        """Two frames per lineitem, and a truncated third one."""
        x, y, z = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
        comment = F.when(F.col("l_returnflag") == "A", F.format_string("Erel: %.2f kcal/mol Etot: -123.45 Eh", x)).when(
            F.col("l_returnflag") == "N", F.format_string("Energy: -123.456 Eh %.2f", x)
        ).otherwise(F.format_string("  %.2f", -x))
        content = F.concat(
            F.lit("3\n"), comment, F.format_string("\nO %.2f %.2f %.2f\nH 0.0 0.0 0.5\nH 0.5 0.0 0.0\n\n", x, y, z),
            F.format_string("1\nsecond\nC %.2f 1.0 2.0\n9\ncut off\nH 0 0 0\n", z),
        )
        key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        return spread(self.table("lineitem")).select(key.alias("file_id"), content.alias("content"))

    def accounting_lines(self) -> DataFrame:
        kind = F.col("event_type")
        state = (
            F.when(kind == "purchase", "|COMPLETED|0:0").when(kind == "error", "|FAILED|1:0")
            .when(kind == "view", "|CANCELLED by 0|0:0|x").when(kind == "click", "||").otherwise("|RUNNING")
        )
        task = F.concat_ws("_", F.col("user_id"), F.col("event_id") % 8 + 1)
        return self.table("events").select(
            F.col("user_id").alias("job_id"), F.col("event_id").alias("line_no"), F.concat(task, state).alias("line")
        )

    def manifest_texts(self) -> DataFrame:
        status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
        full = (
            '{"schema":"wf.manifest.v1","ok":true,"step":"screen","created_at_unix":%s,"runtime_seconds":1.5,'
            '"cwd":"/d","inputs":{"raw_argv":[]},"upstream":{"ok":true,"manifest_path":"/d/up%s.json"},"failures":[],'
            '"artifacts":{"accepted":[{"path_abs":"/d/%s_1.xyz","index":1,"rel_energy_kcal":0.5},"/d/%s_2.xyz",'
            '{"path":"/d/%s_3.log"}],"xyz":["/d/no.xyz"],"files":[{"label":"csv","path_abs":"/d/t.csv"},'
            '{"label":"Orca_Energies","path_abs":"/d/%s.txt"}],"array":{"n_tasks":3}}}'
        )
        ensemble = (
            '{"schema":"wf.result.v1","step":"search","cwd":"/d","artifacts":{"accepted":[],'
            '"xyz_ensemble":["/d/%s_ens.xyz","/d/%s_ens2.xyz"],"plots":[{"path_abs":"/d/%s.png","dpi":300}],"files":[{"path_rel":"/d/%s.energies"},'
            '{"label":"energies","path_abs":"/d/later"}]},"failures":[{"error":"no_energies","task":%s},"stopped"]}'
        )
        single = '{"ok":false,"step":"embed","artifacts":{"xyz":[{"path_abs":"","path":"/d/%s_s.xyz"}]}}'

        def filled(template: str) -> Column:
            return F.format_string(template, *[key] * template.count("%s"))

        # some of the third kind can't be read
        broken = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit('{"ok":'), key)).when(F.col("o_orderpriority") == "2-HIGH", key)
        text = F.when(status == "F", filled(full)).when(status == "O", filled(ensemble)).otherwise(F.coalesce(broken, filled(single)))
        return spread(self.table("orders")).select(F.concat(F.lit("/m/"), key).alias("manifest_path"), text.alias("text"))

    def pointer_texts(self) -> DataFrame:
        kind, key = F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
        text = (
            F.when(kind == "1-URGENT", F.concat(F.lit('{"schema":"wf.pointer.v1","ok":true,"manifest_path":"/m/'), key, F.lit('"}')))
            .when(kind == "2-HIGH", F.concat(F.lit(' {"schema":"wf.pointer.v1","manifest_path":"/m/'), key, F.lit('"}\n')))
            .when(kind == "3-MEDIUM", F.concat(F.lit('{"schema":"other","ok":true,"manifest_path":"/m/'), key, F.lit('"}')))
            .when(kind == "4-NOT SPECIFIED", F.lit('{"schema":"wf.pointer.v1","ok":true,"manifest_path":""}'))
            .otherwise(F.concat(F.lit("[1, "), key, F.lit("]")))
        )
        return spread(self.table("orders")).select(F.col("o_orderkey").alias("run_id"), text.alias("text"))

    # molecules: an order is a molecule, its line numbers are the atoms

    def atoms(self) -> DataFrame:
        items = self.table("lineitem")
        return items.groupBy(F.col("l_orderkey").alias("ensemble_id"), F.col("l_linenumber").alias("atom_index")).agg(
            F.min(self.element()).alias("element"), F.min("l_linestatus").alias("class_id"),
            F.min(F.when(F.col("l_tax") < 0.08, F.col("l_discount"))).alias("ppm"),
        )

    def bonds(self) -> DataFrame:
        other = ((F.col("l_linenumber") + F.col("l_quantity").cast("int")) % 7 + 1).cast("int")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("ensemble_id"), F.col("l_linenumber").alias("a"), other.alias("b"))

    def j_edges(self) -> DataFrame:
        i = F.col("l_linenumber")
        j = ((i + F.col("l_quantity").cast("int")) % 7 + 1).cast("int")
        return self.table("lineitem").where(i != j).groupBy(
            F.col("l_orderkey").alias("ensemble_id"), F.least(i, j).alias("i"), F.greatest(i, j).alias("j")
        ).agg(F.min(F.col("l_tax") * F.lit(10.0)).alias("hz"))

    # events of array jobs: a user is a job of eight tasks

    @staticmethod
    def signals(events: DataFrame) -> DataFrame:
        kind = F.col("event_type")
        signal = (
            F.when(kind == "purchase", "done_success").when(kind == "error", "done_failed")
            .when(kind.isin("signup", "view"), "started").otherwise("orca_opt.out")
        )
        return events.select(
            F.col("user_id").alias("job_id"), (F.col("event_id") % 8 + 1).cast("int").alias("task_idx"),
            F.col("ts").cast("timestamp").alias("ts"), signal.alias("signal"),
        )

    def task_events(self) -> DataFrame:
        return self.signals(self.table("events"))

    def task_event_stream(self) -> DataFrame:
        schema = self.table("events").schema
        stream = self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.folder)
        return self.signals(stream)

    def job_sizes(self) -> DataFrame:
        jobs = self.table("events").select(F.col("user_id").alias("job_id")).distinct()
        return jobs.withColumn("n_tasks", F.lit(9))

    # configuration words: one cell of an order is one setting

    def settings(self) -> DataFrame:
        kind, key = F.col("o_orderpriority"), F.col("o_orderkey")
        text = (
            F.when(kind == "1-URGENT", F.format_string("  %d ", key)).when(kind == "2-HIGH", F.format_string("%.2f", F.col("o_totalprice")))
            .when(kind == "3-MEDIUM", F.when(key % 2 == 0, " AUTO ").otherwise("None"))
            .when(kind == "4-NOT SPECIFIED", F.when(key % 2 == 0, " Yes").otherwise("off ")).otherwise(F.lit("x y"))
        )
        return self.table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", text.alias("text"))

    # documents: an order is a screening run whose record may have a flaw

    def screen_texts(self) -> DataFrame:
        """A contract-conforming document per order, with one flaw by priority and another by status."""
        kind, status, key = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
        record = '{"index":%s,"path_abs":"/d/%s.xyz","sha256":"ab"%s}'
        first = F.format_string(record, F.when(kind == "1-URGENT", "0").otherwise("1"), key, F.lit(',"label":"c1"'))
        second = F.format_string(
            record, F.when(kind == "2-HIGH", "1").otherwise("2"), key,
            F.when(kind == "3-MEDIUM", ',"energy_kcal":"low","cluster_id":1.5').otherwise(',"energy_kcal":1,"metrics":{}'))
        third = F.when(kind == "4-NOT SPECIFIED", '{"index":3,"path_abs":"/d/x.xyz","rel_energy_kcal":1.0}').otherwise(
            F.format_string(record, F.lit("3"), key, F.lit(',"rejected_reason":"cluster_dup"')))
        inputs = F.format_string(
            '{"raw_argv":[],"method":"%s","n_input":3,"n_accepted":%s,"n_rejected":1%s}',
            F.when(kind == "5-LOW", "auto").otherwise("own"), F.when(status == "O", "7").otherwise("2"),
            F.when(status == "O", "").otherwise(',"best_chosen_by":"lowest_rel_energy_kcal"'))
        best = '{"label":"%s","path_abs":"/d/best.xyz","sha256":"cd"}'
        full = F.concat(
            F.lit('{"schema":"wf.result.v1","ok":true,"cwd":"/d","failures":[],"inputs":'), inputs,
            F.lit(',"artifacts":{"accepted":['), first, F.lit(","), second, F.lit('],"rejected":['), third,
            F.lit('],"xyz_ensemble":[' + best % "accepted_ensemble" + '],"xyz":['),
            F.when(status == "O", best % "first").otherwise(best % "best"), F.lit("]}}"))
        bare = F.concat(F.lit('{"schema":"v0","ok":true,"inputs":{"method":"own"},"artifacts":{"accepted":{},"array":[1],"x_'), key,
                        F.lit('":"text"}}'))
        return spread(self.table("orders")).select(
            F.concat(F.lit("/m/"), key).alias("manifest_path"), F.when(status == "P", bare).otherwise(full).alias("text"))

    def runs(self) -> DataFrame:
        """A conversation is a chain of runs, a turn each; long answers are failed runs."""
        turn, conv = F.col("turn"), F.col("conv_id")
        return self.table("conversations").select(
            F.concat_ws("/", conv, turn).alias("run"),
            F.when(turn > 0, F.concat_ws("/", conv, turn - 1)).alias("upstream"),
            (F.length("text") <= 400).alias("ok"),
        )

    # geometry: an order is a conformer, its lineitems are atoms; an embedding is a point

    def coordinates(self) -> DataFrame:
        """One atom per line number: the lowest values of its lineitems. The atoms of a conformer are in one partition."""
        return self.observed().repartition("ensemble_id", "conf_idx").groupBy("ensemble_id", "conf_idx", F.col("l_linenumber").alias("atom_index")).agg(
            F.min(self.element()).alias("element"),
            F.min(F.col("l_quantity") * F.lit(1.0371319)).alias("x"),
            F.min(F.col("l_discount") * F.lit(100.37131)).alias("y"),
            F.min(F.col("l_tax") * F.lit(97.13137)).alias("z"),
        )

    def descriptors(self) -> DataFrame:
        """A small set of points per nation: each customer by balance and keys."""
        return self.table("customer").select(
            F.col("c_nationkey").alias("ensemble_id"), F.col("c_custkey").alias("conf_idx"),
            F.round(F.col("c_acctbal") / 1000, 3).alias("u"), F.length("c_mktsegment").cast("double").alias("v"),
            F.col("c_acctbal").alias("energy_kcal"),
        )

    def embedding_points(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("label").alias("ensemble_id"), F.col("vec_id").alias("conf_idx"),
            F.transform("embedding", lambda v: v.cast("double")).alias("features"),
        )
