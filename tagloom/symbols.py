"""What a symbol's description says: category, usual tag prefix and shape."""

from __future__ import annotations

# Words of a description, the category and the usual tag prefix; the first row with a word in the description counts.
CATEGORIES = [
    (("FLOW CONTROL", "FCV"), "Control Valve", "FC"),
    (("TEMPERATURE CONTROL", "TCV"), "Control Valve", "TC"),
    (("PRESSURE CONTROL", "PCV"), "Control Valve", "PC"),
    (("SHUTDOWN VALVE", "ESDV", "SDV"), "Safety/Shutdown", "XV"),
    (("EMERGENCY SHUTDOWN",), "Safety/Shutdown", "ESDV"),
    (("SOLENOID VALVE",), "Valve", "SV"),
    (("MOTOR OPERATED",), "Valve", "MOV"),
    (("BALL VALVE",), "Valve", "BV"),
    (("BUTTERFLY VALVE",), "Valve", "XV"),
    (("GATE VALVE",), "Valve", "GV"),
    (("GLOBE VALVE",), "Valve", "XV"),
    (("NEEDLE VALVE",), "Valve", "NV"),
    (("PLUG VALVE",), "Valve", "PV"),
    (("NON RETURN VALVE",), "Valve", "NRV"),
    (("PRESSURE SAFETY VALVE", "PSV"), "Safety/Shutdown", "PSV"),
    (("SAFETY RELIEF VALVE", "SRV"), "Safety/Shutdown", "SRV"),
    (("ON OFF VALVE",), "Valve", "XV"),
    (("CHOKE VALVE",), "Valve", "CV"),
    (("QUICK EXHAUST",), "Valve", "QEV"),
    (("FLOAT VALVE",), "Valve", "FV"),
    (("WING VALVE",), "Valve", "WV"),
    (("DOUBLE BLOCK",), "Valve", "DBBV"),
    (("3-WAY SOLENOID",), "Valve", "SV"),
    (("FLOW INDICATING TRANSMITTER", "FIT"), "Transmitter", "FIT"),
    (("FLOW TRANSMITTER",), "Transmitter", "FT"),
    (("LEVEL INDICATING TRANSMITTER", "LIT"), "Transmitter", "LIT"),
    (("LEVEL TRANSMITTER",), "Transmitter", "LT"),
    (("PRESSURE INDICATING TRANSMITTER", "PIT"), "Transmitter", "PIT"),
    (("PRESSURE TRANSMITTER",), "Transmitter", "PT"),
    (("TEMPERATURE INDICATING TRANSMITTER",), "Transmitter", "TIT"),
    (("TEMPERATURE TRANSMITTER",), "Transmitter", "TT"),
    (("DIFFERENTIAL PRESSURE INDICATING",), "Transmitter", "DPIT"),
    (("CORROSION TRANSMITTER",), "Transmitter", "CT"),
    (("DENSITY INDICATING TRANSMITTER",), "Transmitter", "DIT"),
    (("FLOW ELEMENT",), "Element", "FE"),
    (("LEVEL ELEMENT",), "Element", "LE"),
    (("TEMPERATURE ELEMENT",), "Element", "TE"),
    (("ANALYZER ELEMENT",), "Element", "AE"),
    (("CORROSION ELEMENT",), "Element", "CE"),
    (("CORROSION COUPON",), "Corrosion Monitoring", "CC"),
    (("CORROSION PROBE",), "Corrosion Monitoring", "CP"),
    (("FLOW GAUGE",), "Gauge", "FG"),
    (("LEVEL GAUGE",), "Gauge", "LG"),
    (("PRESSURE GAUGE",), "Gauge", "PG"),
    (("TEMPERATURE GAUGE",), "Gauge", "TG"),
    (("DIFFERENTIAL PRESSURE GAUGE",), "Gauge", "DPG"),
    (("LEVEL INDICATOR",), "Indicator", "LI"),
    (("PRESSURE INDICATOR",), "Indicator", "PI"),
    (("TEMPERATURE INDICATOR",), "Indicator", "TI"),
    (("LEVEL SWITCH",), "Switch", "LS"),
    (("LIMIT SWITCH CLOSE",), "Switch", "LSC"),
    (("LIMIT SWITCH OPEN",), "Switch", "LSO"),
    (("LIMIT SWITCH",), "Switch", "LS"),
    (("PRESSURE SWITCH",), "Switch", "PS"),
    (("SELECTOR SWITCH",), "Switch", "SS"),
    (("HAND SWITCH OPEN",), "Switch", "HSO"),
    (("HAND SWITCH CLOSE",), "Switch", "HSC"),
    (("FLOW TOTALISER", "FLOW TOTALIZER"), "Totaliser", "FQI"),
    (("ANALYZER",), "Analyzer", "AT"),
    (("AIR COMPRESSOR",), "Compressor", "KC"),
    (("CENTRIFUGAL PUMP",), "Pump", "P"),
    (("RECIPROCATING PUMP",), "Pump", "P"),
    (("ROTOR PUMP",), "Pump", "P"),
    (("VERTICAL PUMP",), "Pump", "P"),
    (("VERTICAL SUMP PUMP",), "Pump", "P"),
    (("HEAT EXCHANGER",), "Heat Transfer", "E"),
    (("AIR COOLER",), "Heat Transfer", "E"),
    (("COALESCER",), "Separation", "S"),
    (("FILTER STRAINER", "Y-TYPE FILTER"), "Filter/Strainer", "STR"),
    (("RESTRICTION ORIFICE",), "Flow Element", "RO"),
    (("THERMOWELL",), "Temperature", "TW"),
    (("SIGHT GLASS",), "Gauge", "SG"),
    (("VESSEL",), "Vessel", "V"),
    (("TANK",), "Tank", "TK"),
    (("FLOATING ROOF TANK",), "Tank", "TK"),
    (("PIG LAUNCHER",), "Pipeline Pigging", "PL"),
    (("PIG RECEIVER",), "Pipeline Pigging", "PR"),
    (("PIG SIGNALER",), "Pipeline Pigging", "PS"),
    (("MOTOR",), "Electrical", "M"),
    (("BLOWER",), "Rotating", "BL"),
    (("STATIC MIXER",), "Mixing", "MX"),
    (("FLAME ARRESTER",), "Safety", "FA"),
    (("AIR DRYER",), "Utility", "AD"),
    (("AIR RECEIVER",), "Utility", "AR"),
    (("EXHAUST SILENCER",), "Utility", "SIL"),
    (("INJECTION QUILL",), "Chemical Injection", "QU"),
    (("I/P CONVERTER",), "Converter", "IP"),
    (("ELECTRO-PNEUMATIC",), "Converter", "EP"),
    (("INDICATION LAMP CLOSE",), "Indication", "IL"),
    (("INDICATION LAMP OPEN",), "Indication", "IL"),
    (("LIGHT ALARM",), "Alarm", "LA"),
    (("BI-DIRECTIONAL POSITION",), "Position", "ZIT"),
    (("PIPELINE TAG",), "Pipeline", "LINE"),
    (("INDUCTOR", "EJECTOR"), "Process", "EJ"),
    (("FIRED HEATER",), "Heater", "H"),
    (("CALIBRATION POT",), "Instrument Accessory", "CAL"),
    (("COOLING FAN",), "Cooling", "CF"),
    (("COMPUTER FUNCTION", "SIGNAL TAG"), "Signal/Logic", "FC"),
    (("DCS", "SIGNAL TAG"), "Signal/Logic", ""),
    (("PLC", "SIGNAL TAG"), "Signal/Logic", ""),
    (("NON MAINTAINABLE",), "Non-Maintainable", ""),
    (("DESTINATION ARROW",), "Drawing Annotation", ""),
    (("INSULATING COUPLING",), "Piping", ""),
    (("FLANGE",), "Piping", ""),
    (("TUNDISH",), "Piping", ""),
    (("REDUCER",), "Piping", ""),
    (("CAUSE AND EFFECTS",), "Logic/Control", ""),
    (("SOFT TAG",), "Signal/Logic", ""),
    (("INSULATION",), "Piping Annotation", ""),
    (("BARRED TEE",), "Piping", ""),
    (("MANWAY",), "Vessel Accessory", ""),
    (("TIE-IN",), "Tie-In", ""),
    (("DIAPHRAGM SEAL",), "Instrument Accessory", ""),
    (("REVISION TRIANGLE",), "Drawing Annotation", ""),
]
# How symbols of a category look.
SHAPES = {
    "Transmitter": ("circle", "bubble", "letter code inside circle", "line below"),
    "Gauge": ("circle", "bubble", "letter code inside circle"),
    "Indicator": ("circle", "bubble", "indicator letters"),
    "Switch": ("circle", "bubble", "S prefix or letter"),
    "Element": ("circle or small symbol", "element shape", "field instrument"),
    "Control Valve": ("bow-tie shape", "triangle", "actuator on top", "valve body"),
    "Valve": ("valve body shape", "line through symbol"),
    "Safety/Shutdown": ("valve with actuator", "spring symbol", "safety marker"),
    "Pump": ("circle with arrow", "rotating symbol"),
    "Compressor": ("diamond or rectangle", "rotating machinery"),
    "Heat Transfer": ("zigzag lines", "shell and tube symbol"),
    "Vessel": ("tall rectangle", "vessel outline"),
    "Tank": ("wide rectangle", "tank outline"),
    "Filter/Strainer": ("Y-shape or mesh symbol", "filter body"),
    "Signal/Logic": ("hexagon", "diamond", "dashed box", "logic symbol"),
    "Piping": ("line annotation", "piping fitting symbol"),
    "Pipeline Pigging": ("arrow in pipe", "pig symbol"),
    "Corrosion Monitoring": ("box with CC or CP", "inline probe symbol"),
}
# What further words of a description add to its shape; all words of a row must be there.
EXTRAS = [
    (("INDICATING",), "indicating (I letter in tag)"),
    (("RECORDING",), "recording (R letter in tag)"),
    (("SWITCH", "OPEN"), "open position indicator"),
    (("SWITCH", "CLOSE"), "closed position indicator"),
    (("3-WAY",), "three-port valve body"),
]
