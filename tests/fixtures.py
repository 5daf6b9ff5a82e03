"""I94-shaped mini fixtures (hand-written; FIXTURES.md section 1)."""

LABEL_FILE = """libname library 'Your file location' ;
proc format library=library ;

/* I94CIT & I94RES - countries */
  value i94cntyl
   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'
   236 =  'AFGHANISTAN'
   996 =  'No Country Code (996)' ;


/* I94PORT - ports */
  value $i94prtl
   'ALC'\t=\t'ALCAN, AK             '
   'DAC'\t=\t'DALTONS CACHE, AK     '
   'INT'\t=\t'INT''L FALLS, MN      '
   'POM'\t=\t'PORTLAND, ME          '
   'OTM'\t=\t'OTAY MESA, CA         '
   'SFR'\t=\t'SAN FRANCISCO, CA     '
   'OAK'\t=\t'OAKLAND, CA           '
   'PDX'\t=\t'PORTLAND, OR          '
   'MES'\t=\t'MESA, AZ'
   'CP '\t=\t'No PORT Code (CP)'
   'OSN' \t=\t'No PORT Code (OSN)'
;


/* I94MODE */
value i94model
\t1 = 'Air'
\t9 = 'Not reported' ;
"""

PORTS = [
    ("ALC", "ALCAN, AK"),
    ("DAC", "DALTONS CACHE, AK"),
    ("INT", "INT'L FALLS, MN"),
    ("POM", "PORTLAND, ME"),
    ("OTM", "OTAY MESA, CA"),
    ("SFR", "SAN FRANCISCO, CA"),
    ("OAK", "OAKLAND, CA"),
    ("PDX", "PORTLAND, OR"),
    ("MES", "MESA, AZ"),
    ("CP ", "No PORT Code (CP)"),
    ("OSN", "No PORT Code (OSN)"),
]

NAN = float("nan")

# cicid, arrdate, depdate, i94port, i94addr, i94bir, gender, i94visa, count
ARRIVALS = [
    (1.0, 20573.0, 20580.0, "SFR", "CA", 30.0, "F", 2.0, 1.0),
    (1.0, 20573.0, 20580.0, "SFR", "CA", 30.0, "F", 2.0, 1.0),  # exact duplicate
    (2.0, None, None, "OAK", "CA", 40.0, "M", 1.0, 1.0),  # null dates
    (3.0, 0.0, 20590.0, "POM", None, 50.0, None, 3.0, 1.0),  # zero date, null state and gender
    (4.0, 0.4, None, "060", "NY", 22.0, "M", 2.0, 1.0),  # fraction, numeric-looking code
    (5.0, -0.5, None, "888", "NY", 23.0, "F", 2.0, 1.0),
    (6.0, NAN, None, "SFR", "CA", 24.0, "F", 2.0, 1.0),  # NaN date
    (7.0, 20574.0, None, "SFR", "CA", 25.0, "M", 1.0, 1.0),
    (7.0, 20575.0, None, "SFR", "CA", 25.0, "M", 1.0, 1.0),  # same id, another date
]

TEMPERATURE_CSV = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
2013-08-01,18.5,0.3,San Francisco,United States,37.78N,122.03W
2013-08-01,18.5,0.3,San Francisco,United States,37.78N,122.03W
2013-09-01,19.123,0.255,San Francisco,United States,37.78N,122.03W
2013-08-01,20.1,0.2,Oakland,United States,37.78N,122.03W
2013-08-01,20.1,0.2,Oakland,United States,38.00N,122.00W
2013-08-01,25.0,0.1,Paris,France,48.85N,2.35E
2013-08-01,25.0,0.1,Portland,,45.52N,122.68W
2013-08-01,,0.1,Portland,United States,45.52N,122.68W
2013-09-01,NaN,0.1,Portland,United States,45.52N,122.68W
2013-08-01,11.0,0.4,Springfield,United States,42.59N,72.00W
2013-08-01,12.0,0.4,,United States,1.00N,1.00W
1743-11-01,5.5,2.1,Mesa,United States,33.42N,111.83W
"""

DEMOGRAPHICS_CSV = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
Oakland;California;36.5;204000;215000;419000;12000;113000;2.67;CA;White;120000
Oakland;California;36.5;204000;215000;419000;12000;113000;2.67;CA;Asian;70000
Oakland;California;36.5;204000;215000;419000;12000;113000;2.67;CA;Black or African-American;100000
Oakland;California;36.5;204000;215000;419000;12000;113000;2.67;CA;Hispanic or Latino;110000
Oakland;California;36.5;204000;215000;419000;12000;113000;2.67;CA;American Indian and Alaska Native;5000
Oakland;California;36.5;204000;215000;419000;12000;113000;2.67;CA;American Indian and Alaska Native;5000
San Francisco;California;38.5;439000;425000;864000;26000;297000;2.37;CA;White;442000
San Francisco;California;38.5;439000;425000;864000;26000;297000;2.37;CA;;10
San Francisco;California;38.5;439000;425000;864000;26000;297000;2.37;CA;Martian;7
San Francisco;California;38.5;439000;425000;864000;26000;297000;2.37;CA;Asian;12.7
Francisco;California;40.0;1000;1000;0;;;2.00;CA;White;
Springfield;Massachusetts;33.0;1;1;2;1;1;2.5;MA;White;1
"""
