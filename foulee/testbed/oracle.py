"""SQL twins of the catalogue, for an independent engine on the same tables.

They state the expected result in plain SQL and share no code with the operators.
"""

from __future__ import annotations

# Every entry may use the ones before it.
_TABLES = {
    "emp": """
        SELECT CASE WHEN copie = 1 AND c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS id_salarie,
               c_name AS nom,
               'P' || (c_custkey % 7) AS prenom,
               DATE '1960-01-01' + CAST(c_custkey * 37 % 14000 AS INTEGER) AS date_naissance,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Marketing' WHEN 'AUTOMOBILE' THEN 'R&D'
                    WHEN 'MACHINERY' THEN 'Ventes' WHEN 'HOUSEHOLD' THEN 'Support' ELSE c_mktsegment END AS bu,
               CASE WHEN c_custkey % 83 <> 0
                    THEN DATE '2000-01-01' + CAST(c_custkey * 11 % 9000 AS INTEGER) END AS date_embauche,
               CAST(CAST(c_acctbal AS DECIMAL(12, 2)) + 100 * copie AS DECIMAL(12, 2)) AS salaire_brut,
               CASE WHEN c_custkey % 10 = 0 THEN 'Stage' WHEN c_custkey % 10 = 1 THEN NULL
                    WHEN c_custkey % 2 = 0 THEN 'CDI' ELSE 'CDD' END AS type_contrat,
               c_custkey % 6 + 25 AS nb_jours_cp,
               CASE WHEN c_custkey % 61 = 0 THEN NULL
                    WHEN c_custkey % 5 = 0 THEN '  RUE   des Pins ' || (c_custkey // 12) || ' '
                    ELSE 'rue des pins ' || (c_custkey // 12) END AS adresse,
               CASE c_custkey // 3 % 9 WHEN 0 THEN 'Marche/running' WHEN 1 THEN 'Marche/running'
                    WHEN 2 THEN 'Vélo/Trottinette/Autres' WHEN 3 THEN 'Vélo/Trottinette/Autres'
                    WHEN 4 THEN 'Transports en commun' WHEN 5 THEN 'Transports en commun'
                    WHEN 6 THEN 'véhicule thermique/électrique' WHEN 7 THEN 'véhicule thermique/électrique'
                    END AS moyen_deplacement
        FROM (SELECT *, 0 AS copie FROM customer
              UNION ALL
              SELECT *, 1 AS copie FROM customer WHERE c_custkey % 50 = 0 OR c_custkey % 97 = 0)""",
    "sport_names": """
        SELECT * FROM (VALUES (0, 'Runing'), (1, 'Course à pied'), (2, 'Randonnée'), (3, 'Natation'),
            (4, 'Triathlon'), (5, 'Voile'), (6, 'Équitation'), (7, 'Tennis'), (8, 'Badminton'), (9, 'Football'),
            (10, 'Rugby'), (11, 'Basketball'), (12, 'Judo'), (13, 'Boxe'), (14, 'Escalade'),
            (15, 'Tennis de table'), (16, 'Parkour {nom}')) AS v(reste, nom_sport)""",
    "act": """
        SELECT CASE WHEN o_orderkey % 401 = 0 THEN NULL WHEN o_orderkey % 307 = 0 THEN o_custkey + 1000000000
                    ELSE o_custkey END AS id_salarie,
               CASE WHEN o_orderkey % 101 <> 0 THEN nom_sport END AS type_sport,
               CASE WHEN o_orderkey % 89 = 0 THEN -1.0::DOUBLE
                    WHEN o_orderkey % 17 < 7 THEN (o_orderkey * 31 % 30000)::DOUBLE END AS distance_m,
               secondes AS temps_ecoule_s,
               debut AS date_debut,
               CASE WHEN o_orderkey % 211 <> 0 THEN debut + to_seconds(COALESCE(secondes, 0)) END AS date_fin,
               CASE WHEN copie = 1 THEN 'copie'
                    WHEN o_orderkey % 36 = 0 THEN 'Dit "super", oui,' || chr(10) || 'vraiment {nom}'
                    WHEN o_orderkey % 4 = 0 THEN 'Belle séance'
                    WHEN o_orderkey % 4 = 2 THEN '   ' WHEN o_orderkey % 4 = 3 THEN o_orderpriority
                    END AS commentaire,
               CASE WHEN o_orderkey % 503 <> 0 THEN o_orderkey END AS id
        FROM (SELECT *, CASE WHEN o_orderkey % 193 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 0
                             ELSE o_orderkey * 53 % 9000 + 300 END AS secondes,
                     o_orderdate + to_minutes(o_orderkey * 7 % 1440) AS debut
              FROM (SELECT *, 0 AS copie FROM orders
                    UNION ALL SELECT *, 1 AS copie FROM orders WHERE o_orderkey % 50 = 0)) AS o
        JOIN sport_names ON reste = o_orderkey % 17""",
    "declared": """
        SELECT CASE WHEN c_custkey % 89 <> 0 THEN c_custkey END AS id_salarie,
               CASE WHEN copie = 1 THEN 'Yoga' WHEN c_custkey % 3 <> 0 THEN nom_sport END AS sport
        FROM (SELECT c_custkey, 0 AS copie FROM customer
              UNION ALL SELECT c_custkey, 1 AS copie FROM customer WHERE c_custkey % 20 = 0)
        JOIN sport_names ON reste = c_custkey % 17""",
    "geo": """
        SELECT cle, min(lat) AS lat, min_by(lon, lat) AS lon
        FROM (SELECT 'rue des pins ' || s_suppkey AS cle,
                     CASE WHEN s_suppkey % 13 <> 0 THEN (s_suppkey % 41 + 4340 + 3 * copie) / 100.0::DOUBLE END AS lat,
                     (s_suppkey % 37 + 370) / 100.0::DOUBLE AS lon
              FROM (SELECT s_suppkey, 0 AS copie FROM supplier
                    UNION ALL SELECT s_suppkey, 1 AS copie FROM supplier WHERE s_suppkey % 10 = 0))
        WHERE lat IS NOT NULL GROUP BY cle""",
    "ref_sport": """
        SELECT * FROM (VALUES ('Course à pied', 1800::BIGINT, 'cardio'), ('Randonnée', 3600, 'cardio'),
            ('Natation', 1800, 'cardio'), ('Tennis', 2700, 'raquette'), ('Badminton', 1800, 'raquette'),
            ('Football', 3600, 'collectif'), ('Rugby', 3600, 'collectif'), ('Basketball', 3600, 'collectif'),
            ('Judo', 3600, 'combat'), ('Boxe', 2700, 'combat'), ('Escalade', 5400, 'outdoor'),
            ('Triathlon', 5400, 'cardio'), ('Voile', 3000, 'outdoor'), ('Équitation', 3600, 'outdoor'),
            ('Tennis de table', 1800, 'raquette'), ('Runing', 1800, 'cardio'))
            AS v(type_sport, duree_min_s, categorie)""",
    "emp_once": """
        SELECT * FROM emp
        QUALIFY row_number() OVER (PARTITION BY id_salarie ORDER BY nom NULLS FIRST, prenom NULLS FIRST,
            date_naissance NULLS FIRST, bu NULLS FIRST, date_embauche NULLS FIRST, salaire_brut NULLS FIRST,
            type_contrat NULLS FIRST, nb_jours_cp NULLS FIRST, adresse NULLS FIRST,
            moyen_deplacement NULLS FIRST) = 1""",
    "emp_clean": """
        SELECT * FROM emp
        WHERE id_salarie IS NOT NULL AND salaire_brut > 0 AND type_contrat IN ('CDI', 'CDD')
        QUALIFY row_number() OVER (PARTITION BY id_salarie ORDER BY salaire_brut) = 1""",
    "act_clean": """
        SELECT * REPLACE (CASE WHEN type_sport = 'Runing' THEN 'Course à pied' ELSE type_sport END AS type_sport)
        FROM act
        WHERE type_sport IS NOT NULL AND temps_ecoule_s > 0 AND date_debut IS NOT NULL AND date_fin IS NOT NULL
          AND (distance_m IS NULL OR distance_m >= 0)
        QUALIFY row_number() OVER (PARTITION BY id, id_salarie, date_debut ORDER BY
            CASE WHEN type_sport = 'Runing' THEN 'Course à pied' ELSE type_sport END,
            distance_m NULLS FIRST, temps_ecoule_s, date_fin, commentaire NULLS FIRST) = 1""",
    "act_rich": """
        SELECT a.*, r.categorie, r.duree_min_s,
               r.categorie IS NOT NULL AND a.temps_ecoule_s >= r.duree_min_s AS activite_valide
        FROM act_clean a LEFT JOIN ref_sport r USING (type_sport)""",
    "emp_far": """
        SELECT e.*, metres,
               CASE moyen_deplacement WHEN 'Marche/running' THEN 15000.0::DOUBLE
                    WHEN 'Vélo/Trottinette/Autres' THEN 25000.0::DOUBLE END AS limite
        FROM emp e
        LEFT JOIN (SELECT cle, CAST(round_even(2 * 6371000 * asin(sqrt(
                       pow(sin((43.6::DOUBLE - lat) * pi() / 180 / 2), 2)
                       + cos(lat * pi() / 180) * cos(43.6::DOUBLE * pi() / 180)
                         * pow(sin((3.9::DOUBLE - lon) * pi() / 180 / 2), 2))), 0) AS DOUBLE) AS metres
                   FROM geo) g
          ON g.cle = lower(trim(regexp_replace(e.adresse, '\\s+', ' ', 'g')))
         AND moyen_deplacement IN ('Marche/running', 'Vélo/Trottinette/Autres')""",
    "emp_dist": """
        SELECT c.*, f.metres <= f.limite AS declaration_ok, f.metres AS distance_m
        FROM emp_clean c
        JOIN (SELECT DISTINCT id_salarie, metres, limite FROM emp_far) f USING (id_salarie)""",
    "benefits": """
        SELECT id_salarie, montant > 0 AS prime_sportive, montant AS montant_prime,
               CASE WHEN nb >= 15 THEN 5 ELSE 0 END::INTEGER AS jours_bienetre, nb AS nb_activites,
               '2001-08-02' AS date_calcul
        FROM (SELECT d.id_salarie, COALESCE(n.nb, 0) AS nb,
                     CASE WHEN declaration_ok
                           AND moyen_deplacement IN ('Marche/running', 'Vélo/Trottinette/Autres')
                          THEN round(salaire_brut * 0.05, 2)::DOUBLE ELSE 0.0::DOUBLE END AS montant
              FROM emp_dist d
              LEFT JOIN (SELECT id_salarie, count(id) AS nb FROM act_clean GROUP BY id_salarie) n
                USING (id_salarie))""",
    "checks": """
        SELECT * FROM (
        SELECT 1 AS n, 'Pas de doublons ID salarié' AS test, 'doublon(s)' AS unite, true AS critique,
               (SELECT count(*) - count(DISTINCT id_salarie) - max(CASE WHEN id_salarie IS NULL THEN 1 ELSE 0 END)
                FROM emp) AS nb
        UNION ALL SELECT 2, 'Salaire brut > 0', 'salaire(s) invalide(s)', false,
               (SELECT count(*) FROM emp WHERE salaire_brut <= 0)
        UNION ALL SELECT 3, 'Type contrat valide (CDI/CDD)', 'contrat(s) invalide(s)', false,
               (SELECT count(*) FROM emp WHERE type_contrat IS NULL OR type_contrat NOT IN ('CDI', 'CDD'))
        UNION ALL SELECT 4, 'Date d''embauche non nulle', 'date(s) manquante(s)', false,
               (SELECT count(*) FROM emp WHERE date_embauche IS NULL)
        UNION ALL SELECT 5, 'Moyen de déplacement valide', 'mode(s) invalide(s)', false,
               (SELECT count(*) FROM emp WHERE moyen_deplacement IS NULL OR moyen_deplacement NOT IN
                  ('Marche/running', 'Vélo/Trottinette/Autres', 'Transports en commun',
                   'véhicule thermique/électrique'))
        UNION ALL SELECT 6, 'Distance jamais négative', 'distance(s) négative(s)', false,
               (SELECT count(*) FROM act WHERE distance_m < 0)
        UNION ALL SELECT 7, 'Temps écoulé > 0 secondes', 'durée(s) invalide(s)', false,
               (SELECT count(*) FROM act WHERE temps_ecoule_s <= 0)
        UNION ALL SELECT 8, 'Date début < Date fin', 'activité(s) incohérente(s)', true,
               (SELECT count(*) FROM act WHERE date_debut >= date_fin)
        UNION ALL SELECT 9, 'Type sport non nul', 'type(s) manquant(s)', false,
               (SELECT count(*) FROM act WHERE type_sport IS NULL)
        UNION ALL SELECT 10, 'Activités dans les 12 derniers mois', 'activité(s) hors période', false,
               (SELECT count(*) FROM act WHERE date_debut < DATE '2001-08-02' - 366)
        UNION ALL SELECT 11, 'ID salarié existe dans RH', 'ID inconnu(s)', true, (SELECT count(*) FROM orphans)
        UNION ALL SELECT 12, 'Montant prime >= 0', NULL, false,
               (SELECT count(*) FROM benefits WHERE montant_prime < 0)
        UNION ALL SELECT 13, 'Nb activités >= 0', NULL, false,
               (SELECT count(*) FROM benefits WHERE nb_activites < 0)
        UNION ALL SELECT 14, 'Prime uniquement pour déplacement actif', NULL, false,
               (SELECT count(*) FROM benefits b JOIN emp e USING (id_salarie) WHERE prime_sportive AND
                  (moyen_deplacement IS NULL
                   OR moyen_deplacement NOT IN ('Marche/running', 'Vélo/Trottinette/Autres')))
        UNION ALL SELECT 15, 'Bien-être uniquement si >= 15 activités', NULL, false,
               (SELECT count(*) FROM benefits WHERE jours_bienetre > 0 AND nb_activites < 15))""",
    "report": """
        SELECT test, CASE WHEN nb = 0 THEN '✅ PASS' ELSE '❌ FAIL' END AS statut,
               COALESCE(nb || ' ' || unite, '') AS detail, critique, nb AS nb_erreurs
        FROM checks""",
    "payroll": """
        SELECT sum(salaire_brut) FILTER (WHERE prime_sportive) AS masse,
               count(*) FILTER (WHERE prime_sportive) AS nb_primes,
               count(*) FILTER (WHERE jours_bienetre > 0) AS nb_bienetre
        FROM benefits JOIN emp_clean USING (id_salarie)""",
    "limits": """
        SELECT * FROM (VALUES
            ('Course à pied', 100000::DOUBLE, 2.0::DOUBLE, 7.0::DOUBLE, 36000::BIGINT),
            ('Randonnée', 60000, 0.5, 2.5, 50400), ('Natation', 20000, 0.5, 2.5, 28800),
            ('Triathlon', 200000, 1.5, 6.0, 72000), ('Voile', 500000, 0.5, 10.0, 86400),
            ('Tennis', NULL, NULL, NULL, 21600), ('Football', NULL, NULL, NULL, 14400),
            ('Rugby', NULL, NULL, NULL, 14400), ('Badminton', NULL, NULL, NULL, 18000),
            ('Judo', NULL, NULL, NULL, 14400), ('Boxe', NULL, NULL, NULL, 10800),
            ('Escalade', NULL, NULL, NULL, 28800), ('Basketball', NULL, NULL, NULL, 14400),
            ('Équitation', 80000, 0.5, 5.0, 28800), ('Tennis de table', NULL, NULL, NULL, 14400))
            AS v(type_sport, dist_max, vmin, vmax, duree_max)""",
    "decl": """
        SELECT l_orderkey, l_linenumber, l_suppkey AS id_salarie, nom_sport AS type_sport,
               CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 23 = 0 THEN 0.0::DOUBLE
                    WHEN l_partkey % 3 = 0 THEN l_extendedprice / 8.0::DOUBLE
                    WHEN l_partkey % 3 = 1 THEN secondes * 0.9::DOUBLE ELSE l_extendedprice END AS distance_m,
               secondes AS duree_s,
               CASE l_returnflag WHEN 'A' THEN '  ' WHEN 'R' THEN ' ' || chr(9) || 'vu ' || l_linestatus
                    || ' ' || chr(10) END AS commentaire,
               l_shipdate AS date_debut
        FROM (SELECT *, CASE WHEN l_partkey % 67 <> 0
                        THEN (l_partkey * 97 + l_linenumber * 1201) % 90000 - 500 END AS secondes FROM lineitem)
        JOIN sport_names ON reste = l_partkey % 17""",
    "decl_measured": """
        SELECT d.*, l.dist_max, l.vmin, l.vmax, COALESCE(l.duree_max, 86400) AS dmax,
               COALESCE(duree_s, 0) AS t,
               l.dist_max IS NOT NULL AND distance_m > 0 AS mesuree,
               CASE WHEN duree_s > 0 THEN (distance_m / 1000::DOUBLE) / (duree_s / 3600::DOUBLE) END AS v
        FROM decl d LEFT JOIN limits l USING (type_sport)""",
    "decl_errors": """
        SELECT *,
            CASE WHEN t <= 0 THEN 'La duree doit etre superieure a 0 seconde.' END AS e1,
            CASE WHEN t > dmax THEN 'Duree trop longue pour ' || type_sport || ' : max '
                || printf('%.1f', dmax / 3600::DOUBLE) || 'h (vous avez saisi '
                || printf('%.1f', t / 3600::DOUBLE) || 'h).' END AS e2,
            CASE WHEN t < 300 THEN 'Duree trop courte : minimum 5 minutes.' END AS e3,
            CASE WHEN mesuree AND distance_m > dist_max THEN 'Distance impossible pour ' || type_sport || ' : max '
                || printf('%.0f', dist_max / 1000::DOUBLE) || ' km (vous avez saisi '
                || printf('%.1f', distance_m / 1000::DOUBLE) || ' km).' END AS e4,
            CASE WHEN mesuree AND v > vmax THEN 'Vitesse impossible : ' || printf('%.1f', v) || ' km/h pour '
                || type_sport || ' (max realiste : ' || vmax || ' km/h). Verifiez distance/duree.' END AS e5,
            CASE WHEN mesuree AND v < vmin THEN 'Vitesse trop lente : ' || printf('%.2f', v) || ' km/h pour '
                || type_sport || ' (min : ' || vmin || ' km/h). Verifiez distance/duree.' END AS e6
        FROM decl_measured""",
    "decl_counted": """
        SELECT *, concat_ws(' | ', e1, e2, e3, e4, e5, e6) AS erreurs,
               (e1 IS NOT NULL)::INTEGER + (e2 IS NOT NULL)::INTEGER + (e3 IS NOT NULL)::INTEGER
               + (e4 IS NOT NULL)::INTEGER + (e5 IS NOT NULL)::INTEGER + (e6 IS NOT NULL)::INTEGER AS nb_erreurs
        FROM decl_errors""",
    "decl_ok": """
        SELECT id_salarie, date_debut, type_sport,
               CASE WHEN dist_max IS NOT NULL AND distance_m <> 0 THEN distance_m END AS distance_m,
               duree_s AS temps_ecoule_s, date_debut + to_seconds(duree_s) AS date_fin,
               nullif(regexp_replace(commentaire, '^\\s+|\\s+$', '', 'g'), '') AS commentaire
        FROM decl_counted WHERE nb_erreurs = 0""",
    "cdc_all": """
        SELECT event_id, user_id,
               CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'c' WHEN 'purchase' THEN 'r'
                    WHEN 'view' THEN 'u' ELSE 'd' END AS op,
               event_id % 13 = 0 AS tombe, event_id % 37 = 0 AS vide,
               event_id % 13 <> 0 AND event_id % 11 = 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0 AS casse,
               event_id % 13 <> 0 AND event_id % 41 = 0 AS nul,
               CASE WHEN event_id % 53 = 0 THEN 1 ELSE CASE event_id % 6 WHEN 0 THEN m WHEN 1 THEN m + 0.5::DOUBLE WHEN 2 THEN m WHEN 3 THEN m + 1
                    ELSE 0 END END::DOUBLE AS distance_m,
               CASE event_id % 7 WHEN 0 THEN 'Course à pied' WHEN 1 THEN 'Running' WHEN 2 THEN 'Randonnée'
                    WHEN 3 THEN 'Natation' WHEN 4 THEN 'Tennis' ELSE 'Sport' END AS type_sport,
               CASE WHEN event_id % 47 = 0 THEN 1 WHEN event_id % 8 <> 0 THEN event_id * 37 % 7000 ELSE 0 END AS temps_ecoule_s,
               CASE event_id % 3 WHEN 0 THEN 'bravo' WHEN 1 THEN '  ' END AS commentaire
        FROM (SELECT *, round(value * 100)::BIGINT AS m FROM events)""",
    "cdc_announced": """
        SELECT *, CASE WHEN event_id % 29 = 0 OR event_id % 59 = 0 THEN 'type_sport'
                  WHEN event_id % 31 = 0 OR event_id % 43 = 0 THEN 'temps_ecoule_s'
                  END AS motif
        FROM cdc_all WHERE NOT tombe AND NOT casse AND NOT nul AND NOT vide AND op IN ('c', 'r')""",
    "rejected": """
        SELECT event_id, CASE WHEN casse THEN 'json' ELSE 'payload' END AS motif FROM cdc_all WHERE casse OR nul
        UNION ALL SELECT event_id, motif FROM cdc_announced WHERE motif IS NOT NULL""",
    "cdc_text": """
        SELECT event_id,
               CASE WHEN contains(type_sport, 'Course') OR contains(type_sport, 'Run')
                    THEN 'Bravo *' || qui || '* ! Tu viens de courir ' || km || ' km en ' || mn
                         || ' min ! Quelle énergie ! 🏃‍♂️🔥'
                    WHEN contains(type_sport, 'Rando')
                    THEN 'Magnifique *' || qui || '* ! Une randonnée de ' || km || ' km terminée ! 🥾'
                    ELSE 'Bravo *' || qui || '* ! ' || km || ' km de ' || type_sport || ' en ' || mn
                         || ' min ! 🏅' END
               || CASE WHEN trim(commentaire) <> '' THEN chr(10) || '> _' || commentaire || '_' ELSE '' END
               AS message
        FROM (SELECT c.*, printf('%.1f', c.distance_m / 1000) AS km,
                     CAST(round_even(c.temps_ecoule_s / 60::DOUBLE, 0) AS BIGINT) AS mn,
                     COALESCE(prenom || ' ' || nom, 'Salarié ' || user_id) AS qui
              FROM cdc_announced c LEFT JOIN emp_clean e ON e.id_salarie = c.user_id WHERE motif IS NULL)""",
    "act_named": """
        SELECT a.*, prenom, nom, COALESCE(id, 0) % 2 = 0 AS premier,
               printf('%.1f', distance_m / 1000) AS km, printf('%.0f', distance_m) AS metres,
               COALESCE(CAST(CAST(round_even(temps_ecoule_s / 60::DOUBLE, 0) AS BIGINT) AS VARCHAR), '?') AS mn,
               CASE WHEN nom IS NULL THEN 'Salarié ' || COALESCE(CAST(id_salarie AS VARCHAR), '?')
                    ELSE prenom || ' ' || nom END AS qui
        FROM act a LEFT JOIN emp_clean e USING (id_salarie)""",
    "act_text": """
        SELECT id, id_salarie, type_sport, date_debut, distance_m, temps_ecoule_s, commentaire,
               CASE type_sport
               WHEN 'Runing' THEN CASE WHEN premier
                    THEN 'Bravo ' || qui || ' ! Tu viens de courir ' || d || ' km en ' || mn
                         || ' min ! Quelle énergie ! 🏃‍♂️🔥'
                    ELSE 'Superbe sortie ' || qui || ' ! ' || d || ' km avalés en ' || mn || ' min ! Respect ! 💪' END
               WHEN 'Randonnée' THEN CASE WHEN premier
                    THEN 'Magnifique ' || qui || ' ! Une randonnée de ' || d || ' km terminée ! 🥾🌄'
                         || CASE WHEN trim(commentaire) <> '' THEN chr(10) || '> _' || commentaire || '_' ELSE '' END
                    ELSE 'Bravo ' || qui || ' ! ' || d || ' km de randonnée en ' || mn || ' min ! Nature lover ! 🌿' END
               WHEN 'Natation' THEN CASE WHEN premier
                    THEN 'Splash ! ' || qui || ' vient de nager ' || d || ' m en ' || mn || ' min ! 🏊‍♂️💦'
                    ELSE 'Bravo ' || qui || ' ! ' || d || ' m dans l''eau en ' || mn || ' min ! Champion(ne) ! 🏊' END
               WHEN 'Tennis' THEN CASE WHEN premier
                    THEN 'Ace ! ' || qui || ' vient de jouer ' || mn || ' min de tennis ! 🎾'
                    ELSE 'Bravo ' || qui || ' ! Belle séance de tennis de ' || mn || ' min ! 🎾' END
               ELSE CASE WHEN premier
                    THEN 'Bravo ' || qui || ' ! Belle séance de ' || COALESCE(type_sport, '?') || ' de ' || mn
                         || ' min ! ' || emoji
                    ELSE 'Superbe ' || qui || ' ! ' || mn || ' min de ' || COALESCE(type_sport, '?')
                         || ' au compteur ! ' || emoji END
               END AS message
        FROM (SELECT *, CASE WHEN type_sport = 'Natation' AND metres NOT IN ('0', '-0') THEN metres
                             WHEN type_sport <> 'Natation' AND km NOT IN ('0.0', '-0.0') THEN km ELSE '?' END AS d,
                     CASE type_sport WHEN 'Football' THEN '⚽' WHEN 'Rugby' THEN '🏉' WHEN 'Badminton' THEN '🏸'
                          WHEN 'Judo' THEN '🥋' WHEN 'Boxe' THEN '🥊' WHEN 'Escalade' THEN '🧗'
                          WHEN 'Équitation' THEN '🐴' WHEN 'Tennis de table' THEN '🏓'
                          WHEN 'Basketball' THEN '🏀' WHEN 'Voile' THEN '⛵' ELSE '🏅' END AS emoji
              FROM act_named)""",
    "orphans": """
        SELECT DISTINCT id_salarie FROM act a
        WHERE NOT EXISTS (SELECT 1 FROM emp e WHERE e.id_salarie = a.id_salarie)""",
}

_SPORT_COUNTS = """
        SELECT r.*, COALESCE(n.nb, 0) AS nb_activites FROM ref_sport r
        LEFT JOIN (SELECT type_sport, count(*) AS nb FROM act GROUP BY type_sport) n USING (type_sport)"""

_LENIENT = """
        SELECT id_salarie, ok AND actif AS prime_sportive,
               CASE WHEN ok AND actif THEN CAST(salaire_brut * 0.05 AS DOUBLE) ELSE 0.0::DOUBLE END AS montant_prime,
               COALESCE(n.nb, 0) >= 15 AS jours_bienetre, COALESCE(n.nb, 0)::INTEGER AS nb_activites,
               '2001-08-02' AS date_calcul
        FROM (SELECT e.*, COALESCE(f.metres <= f.limite, true) AS ok,
                     moyen_deplacement IN ('Marche/running', 'Vélo/Trottinette/Autres') AS actif
              FROM emp_once e
              LEFT JOIN (SELECT DISTINCT id_salarie, metres, limite FROM emp_far) f USING (id_salarie))
        LEFT JOIN (SELECT id_salarie, count(*) AS nb FROM act GROUP BY id_salarie) n USING (id_salarie)"""

_RERATED = """
    SELECT b.* REPLACE (CASE WHEN prime_sportive AND e.id_salarie IS NOT NULL
                        THEN CAST(salaire_brut * {rate} AS DOUBLE) ELSE montant_prime END AS montant_prime)
    FROM benefits b LEFT JOIN emp_clean e USING (id_salarie)"""

# Employee columns with money as a double and dates as text, as the catalogue gives them.
_STAFF = """* REPLACE (CAST(salaire_brut AS DOUBLE) AS salaire_brut,
    CAST(date_naissance AS VARCHAR) AS date_naissance, CAST(date_embauche AS VARCHAR) AS date_embauche)"""

# The tables a query needs besides itself are found by name, so the order here is free.
_LATEST = """
        SELECT id, prenom || ' ' || nom AS salarie, type_sport,
               ((CAST(distance_m AS BIGINT) + 50) // 100) / 10::DOUBLE AS km,
               ((temps_ecoule_s + 30) // 60)::DOUBLE AS minutes,
               commentaire, CAST(date_debut AS VARCHAR) AS date
        FROM act JOIN emp_clean USING (id_salarie)
        ORDER BY date_debut DESC NULLS LAST, id DESC NULLS LAST, id_salarie NULLS FIRST, type_sport NULLS FIRST,
                 distance_m NULLS FIRST, temps_ecoule_s NULLS FIRST, commentaire NULLS FIRST LIMIT 10"""

_LOADED = """
        SELECT *, row_number() OVER (ORDER BY id_salarie NULLS FIRST, date_debut NULLS FIRST, type_sport NULLS FIRST,
                   distance_m NULLS FIRST, temps_ecoule_s NULLS FIRST, date_fin NULLS FIRST,
                   commentaire NULLS FIRST) AS id
        FROM (SELECT id_salarie, type_sport, CASE WHEN distance_m >= 0 THEN distance_m END AS distance_m,
                     temps_ecoule_s, date_trunc('minute', date_debut) AS date_debut,
                     date_trunc('minute', date_fin) AS date_fin, commentaire FROM act)"""

_VALID_ONLY = """
        SELECT b.* REPLACE (COALESCE(n.nb, 0) AS nb_activites,
                            CASE WHEN n.nb >= 15 THEN 5 ELSE 0 END::INTEGER AS jours_bienetre)
        FROM benefits b
        LEFT JOIN (SELECT id_salarie, count(id) AS nb FROM act_rich
                   WHERE activite_valide AND date_debut >= DATE '2000-08-02' GROUP BY id_salarie) n
          USING (id_salarie)"""

_QUERIES = {
    "clean_employees": f"SELECT {_STAFF} FROM emp_clean",
    "clean_activities": "SELECT * FROM act_clean",
    "employee_sport_profile": f"""
        SELECT e.{_STAFF}, s.sport FROM emp_once e
        LEFT JOIN (SELECT id_salarie, min(sport) AS sport FROM declared GROUP BY id_salarie) s
          ON s.id_salarie IS NOT DISTINCT FROM e.id_salarie""",
    "employee_directory": "SELECT id_salarie, nom, prenom FROM emp",
    "enrich_activities": "SELECT * FROM act_rich",
    "employee_bu_check": f"""
        SELECT {_STAFF}, COALESCE(bu IN ('Marketing', 'R&D', 'Ventes', 'Support', 'Finance'), false) AS bu_valide
        FROM emp_clean""",
    "employee_distances": f"SELECT {_STAFF} FROM emp_dist",
    "employee_distances_lenient": f"""
        SELECT e.{_STAFF}, COALESCE(f.metres <= f.limite, true) AS declaration_ok, f.metres AS distance_m
        FROM emp_once e
        LEFT JOIN (SELECT DISTINCT id_salarie, metres, limite FROM emp_far) f USING (id_salarie)""",
    "distance_report": """
        SELECT c.id_salarie, moyen_deplacement AS mode, metres AS distance_m, limite AS distance_max,
               CASE WHEN limite IS NULL THEN true ELSE metres <= limite END AS declaration_ok,
               CASE WHEN limite IS NULL THEN 'Mode non actif' WHEN metres IS NULL THEN 'Adresse non trouvée'
                    WHEN metres <= limite THEN 'OK' ELSE 'Distance excessive' END AS commentaire
        FROM emp_clean c JOIN (SELECT DISTINCT id_salarie, metres, limite FROM emp_far) USING (id_salarie)""",
    "activity_counts": """
        SELECT id_salarie, count(id) AS nb_activites, count(*) AS nb_lignes FROM act GROUP BY id_salarie""",
    "gold_benefits": "SELECT * FROM benefits",
    "benefits_with_declared": """
        SELECT b.* REPLACE (COALESCE(n.nb, 0) AS nb_activites,
                            CASE WHEN n.nb >= 15 THEN 5 ELSE 0 END::INTEGER AS jours_bienetre)
        FROM benefits b
        LEFT JOIN (SELECT id_salarie, sum(nb) AS nb FROM (
                       SELECT id_salarie, count(id) AS nb FROM act_clean GROUP BY id_salarie
                       UNION ALL
                       SELECT id_salarie, count(*) AS nb FROM (
                           SELECT DISTINCT id_salarie, date_debut, type_sport, distance_m, temps_ecoule_s, date_fin, commentaire
                           FROM decl_ok
                           WHERE type_sport IS NOT NULL AND temps_ecoule_s > 0 AND date_debut IS NOT NULL)
                       GROUP BY id_salarie)
                   GROUP BY id_salarie) n USING (id_salarie)""",
    "gold_benefits_valid_only": _VALID_ONLY,
    "recent_from_lake": _VALID_ONLY,
    "gold_benefits_lenient": _LENIENT,
    "lenient_run": _LENIENT,
    "top_bonuses": "SELECT * FROM benefits ORDER BY montant_prime DESC, id_salarie LIMIT 5",
    "silver_report": """
        SELECT (SELECT count(*) FROM emp) AS salaries_bronze, (SELECT count(*) FROM act) AS activites_bronze,
               (SELECT count(*) FROM emp_dist) AS salaries_silver,
               (SELECT count(*) FROM emp_dist WHERE moyen_deplacement IN
                   ('Marche/running', 'Vélo/Trottinette/Autres')) AS deplacement_actif,
               (SELECT count(*) FROM emp_dist WHERE declaration_ok) AS declaration_ok,
               (SELECT count(*) FROM emp_dist WHERE NOT declaration_ok) AS declaration_ko,
               (SELECT count(*) FROM emp_dist WHERE declaration_ok IS NULL) AS declaration_nulle,
               (SELECT count(*) FROM emp_dist WHERE bu IN ('Marketing', 'R&D', 'Ventes', 'Support', 'Finance'))
                   AS bu_valides,
               (SELECT count(*) FROM act_rich) AS activites_silver,
               (SELECT count(*) FROM act_rich WHERE activite_valide) AS activites_valides,
               (SELECT count(*) FROM act_rich WHERE NOT activite_valide) AS activites_invalides""",
    "monitoring_report": """
        SELECT (SELECT count(*) FROM emp) AS nb_salaries, (SELECT count(*) FROM act) AS nb_activites,
               count(*) FILTER (WHERE prime_sportive) AS nb_primes,
               count(*) FILTER (WHERE jours_bienetre > 0) AS nb_bienetre,
               COALESCE(sum(montant_prime::DECIMAL(18, 4))::DOUBLE, 0) AS cout_primes,
               '2001-08-02' AS date_rapport
        FROM benefits""",
    "quality_report": "SELECT * FROM report",
    "quality_summary": """
        SELECT count(*) FILTER (WHERE statut = '✅ PASS') AS nb_pass,
               count(*) FILTER (WHERE statut = '❌ FAIL') AS nb_fail FROM report""",
    "orphan_ids": "SELECT * FROM orphans",
    "scenario_summary": """
        SELECT 8::INTEGER AS taux_pct, nb_primes, cout AS cout_total, COALESCE(cout / nb_primes, 0) AS prime_moyenne,
               nb_bienetre, cout * 5::DOUBLE / 8::DOUBLE AS cout_reference,
               cout - cout * 5::DOUBLE / 8::DOUBLE AS ecart
        FROM (SELECT *, COALESCE(CAST(masse * 0.08 AS DOUBLE), 0) AS cout FROM payroll)""",
    "scenario_costs": """
        SELECT taux_pct, taux_pct || '%' AS taux, cout AS cout_total,
               format('{:,}', CAST(round_even(cout, 0) AS BIGINT)) || ' EUR' AS cout_affiche,
               CASE WHEN taux_pct = 8 THEN '<-- Selectionne' ELSE '' END AS statut
        FROM (SELECT r.pct::INTEGER AS taux_pct, COALESCE(CAST(masse * r.taux AS DOUBLE), 0) AS cout
              FROM payroll, (VALUES (3, 0.03), (5, 0.05), (8, 0.08), (10, 0.10), (15, 0.15)) AS r(pct, taux))""",
    "apply_rate": _RERATED.format(rate="0.08"),
    "restore_rate": _RERATED.format(rate="0.05"),
    "latest_activities": _LATEST,
    "latest_from_lake": _LATEST,
    "latest_messages": """
        SELECT id, id_salarie, type_sport, message FROM act_text
        ORDER BY date_debut DESC NULLS LAST, id DESC NULLS LAST, id_salarie NULLS FIRST, type_sport NULLS FIRST,
                 distance_m NULLS FIRST, temps_ecoule_s NULLS FIRST, commentaire NULLS FIRST LIMIT 10""",
    "activity_messages": "SELECT id, id_salarie, type_sport, message FROM act_text",
    "load_employees": f"SELECT {_STAFF} FROM emp",
    "load_declared_sports": "SELECT * FROM declared",
    "load_activities": _LOADED,
    "loads_numbered": f"""
        SELECT * FROM ({_LOADED})
        UNION ALL BY NAME
        SELECT * REPLACE (id + (SELECT count(*) FROM act) AS id) FROM ({_LOADED})""",
    "declaration_errors": """
        SELECT l_orderkey, l_linenumber, id_salarie, type_sport, dist_max IS NOT NULL AS avec_distance,
               nb_erreurs, erreurs
        FROM decl_counted""",
    "declarations_accepted": "SELECT * FROM decl_ok",
    "declarations_unvalidated": """
        SELECT id_salarie, date_debut, type_sport, distance_m, COALESCE(duree_s, 3600) AS temps_ecoule_s,
               date_debut + to_seconds(COALESCE(duree_s, 3600)) AS date_fin,
               nullif(regexp_replace(commentaire, '^\\s+|\\s+$', '', 'g'), '') AS commentaire
        FROM decl""",
    "declaration_recap": """
        SELECT id_salarie, type_sport, printf('%.1f', distance_m / 1000) AS distance_km,
               temps_ecoule_s // 3600 AS duree_h, temps_ecoule_s % 3600 // 60 AS duree_min,
               temps_ecoule_s % 60 AS duree_s,
               printf('%.1f', (distance_m / 1000::DOUBLE) / (temps_ecoule_s / 3600::DOUBLE)) AS vitesse_kmh,
               strftime(date_debut, '%d/%m/%Y %H:%M') AS date
        FROM decl_ok""",
    "cdc_normalised": """
        SELECT event_id, op, user_id AS id_salarie, CAST(user_id AS VARCHAR) AS id_texte, type_sport, distance_m,
               temps_ecoule_s, commentaire
        FROM cdc_announced WHERE motif IS NULL""",
    "cdc_messages": "SELECT * FROM cdc_text",
    "cdc_rejects": "SELECT * FROM rejected",
    "cdc_stream": "SELECT * FROM cdc_text",
    "declaration_stream": "SELECT * FROM decl_ok",
    "reference_fallback": _SPORT_COUNTS,
    "reference_file": _SPORT_COUNTS,
    "lake_roundtrip": _RERATED.format(rate="0.08"),
    "rerate_in_place": _RERATED.format(rate="0.08"),
    "messages_once": "SELECT * FROM cdc_text",
    # Every rejected event comes twice and at two times: each is kept.
    "feed_measures": """
        SELECT 'messages' AS mesure, count(*) AS nombre FROM cdc_text
        UNION ALL SELECT 'rejets', 2 * count(*) FROM rejected
        UNION ALL SELECT 'rejets:' || m, 2 * count(motif)
        FROM (VALUES ('json'), ('payload'), ('after'), ('type_sport'), ('temps_ecoule_s'), ('commentaire')) AS v(m)
             LEFT JOIN rejected ON motif = m GROUP BY m""",
    "counts_from_feed": """
        SELECT id_salarie, count(id) AS nb_activites, count(*) AS nb_lignes
        FROM (SELECT CASE WHEN event_id % 97 <> 0 THEN event_id END AS id,
                     CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 5 = 0 THEN user_id + 1 ELSE user_id END
                     AS id_salarie
              FROM events WHERE event_id % 7 <> 0)
        GROUP BY id_salarie""",
}


def _mentions(sql: str, name: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a.upper() in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:])) or (
        f", {name}" in sql or f"FROM {name}," in sql
    )


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name, body in _TABLES.items():
        if name not in seen and _mentions(sql, name):
            _needed(body, seen)
            seen.append(name)
    return seen


def oracle_sql() -> dict[str, str]:
    """Query name to one self-contained SQL statement."""
    statements = {}
    for query, sql in _QUERIES.items():
        tables = [f"{name} AS MATERIALIZED ({_TABLES[name].strip()})" for name in _needed(sql, [])]
        statements[query] = f"WITH {', '.join(tables)} {sql.strip()}" if tables else sql.strip()
    return statements
