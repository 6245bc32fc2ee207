"""Word lists, lookup tables and constants.

Every value in this file is a fixed value: results are only right when the
lists hold exactly these words, in this order where order decides.
"""

BLOCK_CM = 100.0
AIR_NAMES = ["minecraft:air", "minecraft:cave_air", "minecraft:void_air"]
DIMENSION_DIRS = [("overworld", ""), ("nether", "DIM-1"), ("end", "DIM1")]
GAME_TYPES = {0: "survival", 1: "creative", 2: "adventure", 3: "spectator"}
MAX_VOXEL_Y = 511
MAX_LOCAL_INDEX = 32767
VOXEL_FILE_MAGIC = b"MC2WV2\0\0"
VOXEL_FILE_VERSION = 2

# --- semantic labels -------------------------------------------------------
LABELS = ["UNKNOWN", "AIR", "TERRAIN", "SUBSURFACE", "WATER", "LAVA",
          "VEGETATION", "STRUCTURE", "PROP", "GLASS", "BEDROCK"]

LABEL_BY_NAME = {
    "bedrock": "BEDROCK", "water": "WATER", "lava": "LAVA",
    "grass_block": "TERRAIN", "sand": "TERRAIN", "gravel": "TERRAIN",
    "snow": "TERRAIN", "snow_block": "TERRAIN", "clay": "TERRAIN",
    "podzol": "TERRAIN", "mycelium": "TERRAIN", "terracotta": "TERRAIN",
    "soul_sand": "TERRAIN", "soul_soil": "TERRAIN", "magma_block": "TERRAIN",
    "end_stone": "TERRAIN", "netherrack": "TERRAIN", "obsidian": "TERRAIN",
    "dirt": "SUBSURFACE", "coarse_dirt": "SUBSURFACE",
    "rooted_dirt": "SUBSURFACE",
    "grass": "VEGETATION", "fern": "VEGETATION", "dead_bush": "VEGETATION",
    "seagrass": "VEGETATION", "tall_seagrass": "VEGETATION",
}
LABEL_LAVA_NAMES = "lava flowing_lava".split()
LABEL_WATER_NAMES = "water bubble_column tipped_water flowing_water".split()
LABEL_WATER_SUFFIX = "_water"
LABEL_PROP_NAMES = """
torch wall_torch soul_torch redstone_torch lantern soul_lantern lever
stone_button polished_blackstone_button tripwire tripwire_hook pressure_plate
light_weighted_pressure_plate heavy_weighted_pressure_plate
stone_pressure_plate polished_blackstone_pressure_plate rail powered_rail
detector_rail activator_rail ladder scaffolding carpet flower_pot skull
skeleton_skull skeleton_wall_skull wither_skeleton_skull creeper_head barrel
chest trapped_chest furnace blast_furnace smoker hopper brewing_stand beacon
bell turtle_egg brush grindstone smithing_table loom lectern stonecutter
composter target amethyst_cluster cactus wall_sign standing_sign wall_banner
standing_banner
""".split()
LABEL_PROP_TOKENS = """
_candle candle_cake cave_vines sculk_sensor sculk chain _rail _fence
_fence_gate _trapdoor _door _button
""".split()
LABEL_GLASS_TOKENS = "glass_pane stained_glass _glass".split()
LABEL_VEGETATION_TOKENS = """
leaves _log sapling _tree vine flower mushroom roots sprouts stems fungus
azalea moss lily kelp wheat carrots potatoes beetroot melon pumpkin sugar_cane
bamboo chorus lily_pad sculk twisting weeping crimson warped nylium shroomlight
candle chorus_plant chorus_flower nether_sprouts crimson_roots warped_roots
crimson_stem warped_stem twisting_vines weeping_vines crimson_fungus
warped_fungus glow_lichen
""".split()
LABEL_WOOD_TOKEN = "wood"
LABEL_STRUCTURE_TOKENS = """
concrete terracotta brick stone_brick cobblestone masonry wall _slab stairs
fence gate beam pillar planks hyphen diorite andesite granite _tile _tiles
quartz sandstone prismarine purpur end_stone_brick basalt blackstone polished
cut_ chiseled smooth_ bricks mud packed suspicious _wood
""".split()
NEVER_GROUND_LABELS = "AIR WATER LAVA BEDROCK".split()
TERRAIN_LABELS = "TERRAIN SUBSURFACE".split()
OBJECT_LABELS = "VEGETATION STRUCTURE PROP GLASS".split()

# --- column hints ----------------------------------------------------------
MAN_MADE_TOKENS = """
concrete terracotta brick cobblestone planks log slab stairs fence wall glass
wool carpet lantern torch rail ladder gravel_path prismarine quartz sandstone
smooth_stone polished cut_ mossy chiseled iron_bars trapdoor door sign banner
flower_pot cauldron anvil enchanting_table crafting_table furnace chest barrel
beacon bell lectern grindstone smithing loom cartography brewing bricks
moss_block sculk nether_bricks hay_block sponge
""".split()
NATURAL_TOKENS = """
dirt grass sand gravel bedrock podzol mycelium snow ice water lava stone
andesite diorite granite deepslate tuff farmland clay end_stone netherrack
magma_block obsidian soul_sand glowstone
""".split()

# --- roles -----------------------------------------------------------------
ROLES = ["empty", "terrain", "structure", "vegetation", "water", "detail"]
ROLE_GLYPHS = {"empty": ".", "terrain": "-", "structure": "#",
               "vegetation": "T", "water": "~", "detail": ":"}
ROLE_WATER_NAMES = "water flowing_water bubble_column seagrass kelp".split()
ROLE_VEGETATION_NAMES = """
grass tall_grass fern large_fern dead_bush dandelion poppy azure_bluet allium
oxeye_daisy cornflower lilac rose_bush peony sunflower sugar_cane bamboo
bamboo_sapling cactus brown_mushroom red_mushroom pumpkin melon wheat carrots
potatoes beetroots lily_pad
""".split()
ROLE_VEGETATION_SUFFIXES = "_leaves _log _wood _sapling".split()
ROLE_DETAIL_NAMES = """
iron_bars oak_fence birch_fence spruce_fence dark_oak_fence acacia_fence
jungle_fence cobblestone_wall stone_brick_wall birch_door oak_door spruce_door
iron_door acacia_door birch_trapdoor oak_trapdoor spruce_trapdoor iron_trapdoor
birch_stairs oak_stairs spruce_stairs stone_stairs birch_slab oak_slab
stone_slab brick_slab quartz_slab oak_sign birch_sign birch_wall_sign
oak_wall_sign torch wall_torch lantern chain rail powered_rail birch_button
oak_button lever ladder chest trapped_chest barrel cauldron bed brown_bed
red_bed white_bed light_blue_bed flower_pot armor_stand item_frame painting
white_carpet light_gray_carpet red_carpet black_carpet cobweb snow vine end_rod
barrier scaffolding lightning_rod redstone_lamp daylight_detector comparator
repeater observer piston sticky_piston dispenser dropper hopper note_block
pressure_plate oak_pressure_plate birch_pressure_plate stone_pressure_plate
tripwire_hook target tnt
""".split()
ROLE_DETAIL_SUFFIXES = """
_button _sign _fence _gate _wall_banner _banner _carpet _stairs _slab _trapdoor
_door _pane _wall _rail _torch
""".split()
ROLE_STRUCTURE_NAMES = """
white_concrete light_gray_concrete gray_concrete white_concrete_powder
light_gray_concrete_powder quartz_block smooth_quartz quartz_pillar
chiseled_quartz_block smooth_sandstone sandstone cut_sandstone
chiseled_sandstone stone_bricks chiseled_stone_bricks cracked_stone_bricks
mossy_stone_bricks smooth_stone polished_andesite polished_diorite
polished_granite bricks nether_bricks terracotta white_terracotta
light_gray_terracotta smooth_stone_slab prismarine prismarine_bricks iron_block
gold_block glass tinted_glass sea_lantern glowstone end_stone_bricks
stripped_oak_log stripped_birch_log stripped_spruce_log
""".split()
ROLE_STRUCTURE_SUFFIXES = \
    "_planks _concrete _terracotta _sandstone _bricks _glass _pane".split()
ROLE_TERRAIN_NAMES = """
grass_block dirt coarse_dirt podzol mycelium farmland dirt_path grass_path sand
red_sand gravel clay snow_block moss_block bedrock stone deepslate andesite
diorite granite tuff calcite cobblestone mossy_cobblestone smooth_stone
stone_bricks cracked_stone_bricks mossy_stone_bricks chiseled_stone_bricks
bricks nether_bricks end_stone
""".split()
ROLE_TERRAIN_SUFFIXES = ["_wool"]

# --- material families -----------------------------------------------------
FAMILIES = """
grass path soil asphalt concrete plaster brick granite tiles roof wood bark
leaves metal gravel rock fabric quartz greystone
""".split()
ATLAS_FAMILIES = FAMILIES + ["other", "water", "sports", "glass", "bars"]
ATLAS_TILE, ATLAS_COLS, ATLAS_PAD = 504, 8, 4

# token:family, first token contained in the name decides
FAMILY_RULES = [tuple(pair.split(":")) for pair in """
glass:glass ice:fabric
leaves:leaves sapling:leaves flower:leaves fern:leaves vine:leaves lily:leaves
grass:grass tall_grass:grass _bush:leaves cactus:leaves sugar_cane:leaves
bamboo:leaves wheat:leaves carrot:leaves potato:leaves beetroot:leaves
melon:leaves pumpkin:leaves cocoa:leaves sweet_berry:leaves
grass_path:path dirt_path:path dirt:soil podzol:soil mycelium:soil
farmland:soil coarse_dirt:soil rooted_dirt:soil mud:soil gravel:gravel
sand:gravel sandstone:gravel clay:soil
quartz:quartz cobblestone:greystone cobble:greystone stone_bricks:greystone
smooth_stone:greystone _bricks:brick brick:brick terracotta:brick
granite:granite diorite:granite andesite:granite basalt:rock blackstone:rock
deepslate:rock obsidian:rock bedrock:rock prismarine:rock _ore:rock
netherrack:rock end_stone:rock purpur:rock stone:greystone
concrete_powder:gravel concrete:concrete plaster:plaster _wall:plaster
_log:bark _stem:bark _wood:bark _hyphae:bark _planks:wood _door:wood
_trapdoor:wood _fence:wood _fence_gate:wood _sign:wood _button:wood
_pressure_plate:wood _stairs:wood _slab:wood bookshelf:wood chest:wood
crafting_table:wood ladder:wood composter:wood barrel:wood loom:wood
cartography_table:wood fletching_table:wood smithing_table:wood note_block:wood
jukebox:wood
roof:roof slate:roof _tile:tiles
iron_bars:bars iron:metal gold:metal copper:metal _rail:metal chain:metal
hopper:metal cauldron:metal anvil:metal bell:metal lantern:metal bar:metal
chain_command:metal beacon:metal conduit:metal
wool:fabric carpet:fabric _bed:fabric banner:fabric canvas:fabric
shulker:plaster target:plaster lodestone:rock spawner:rock tnt:fabric
honey:brick mushroom_block:bark wart:leaves kelp:leaves seagrass:leaves
coral:rock scaffolding:wood torch:metal candle:metal lectern:wood piston:metal
observer:rock dispenser:rock dropper:rock furnace:rock blast_furnace:rock
smoker:rock campfire:wood soul_campfire:wood glowstone:fabric
sea_lantern:fabric lantern:metal redstone_lamp:fabric daylight_detector:wood
repeater:rock comparator:rock lever:metal redstone:fabric redstone_torch:fabric
tripwire:fabric snow:fabric powder_snow:fabric cobweb:fabric web:fabric
tulip:leaves daisy:leaves poppy:leaves bluet:leaves allium:leaves
cornflower:leaves _mushroom:leaves fungus:leaves sprouts:leaves roots:leaves
chorus_plant:leaves potted_:plaster
coal_block:rock lapis_block:rock diamond_block:metal emerald_block:metal
netherite_block:metal ancient_debris:rock magma_block:rock bone_block:plaster
soul_soil:soil nylium:soil bee_nest:bark beehive:bark enchanting_table:wood
brewing_stand:metal end_rod:metal end_portal_frame:rock shroomlight:fabric
""".split()]

# --- colour variants -------------------------------------------------------
DYES = """
light_blue light_gray white orange magenta yellow lime pink gray cyan purple
blue brown green red black
""".split()
VARIANT_TRIMS = "_wall _slab _stairs".split()
VARIANT_EXCLUDED_TOKENS = "nether_brick _concrete_powder glazed blue_ice".split()
VARIANT_FAMILY = {"wool": "fabric", "carpet": "fabric", "bed": "fabric",
                  "stained_glass_pane": "glass", "stained_glass": "glass",
                  "concrete": "concrete", "terracotta": "brick"}
VARIANT_RGB = {
    "concrete_white": (207, 213, 214), "concrete_light_gray": (125, 125, 115),
    "concrete_green": (73, 91, 36), "concrete_cyan": (21, 119, 136),
    "concrete_light_blue": (36, 137, 199), "concrete_red": (142, 33, 33),
    "concrete_lime": (94, 169, 25), "concrete_blue": (45, 47, 143),
    "brick_pink": (160, 77, 78), "brick_cyan": (87, 92, 92),
    "brick_green": (76, 82, 42),
    "fabric_lime": (112, 185, 25), "fabric_green": (84, 109, 27),
    "fabric_white": (233, 236, 236), "fabric_light_blue": (58, 175, 217),
    "fabric_red": (161, 39, 34), "fabric_yellow": (248, 198, 39),
    "fabric_orange": (240, 118, 19), "fabric_black": (20, 21, 25),
    "fabric_brown": (114, 71, 40), "fabric_blue": (53, 57, 157),
    "fabric_gray": (66, 70, 73),
    "glass_white": (205, 208, 206), "glass_black": (20, 21, 25),
    "glass_red": (161, 39, 34), "glass_orange": (240, 118, 19),
    "glass_light_gray": (157, 157, 151),
}
ATLAS_WATER_NAMES = "water flowing_water bubble_column".split()

# --- detail kinds: token:kind, first token contained decides ---------------
DETAIL_KINDS = "window door fence railing stairs trim".split()
DETAIL_KIND_RULES = [tuple(pair.split(":")) for pair in """
pane:window glass:window bars:window window:window sign:window door:door
fence:fence _gate:fence _wall:fence rail:railing chain:railing ladder:railing
torch:railing lantern:railing banner:railing _stairs:stairs _slab:stairs
_pressure_plate:stairs
""".split()]

# --- landmarks, map symbols ------------------------------------------------
LANDMARK_GROUPS = {
    "field": """lime_wool green_wool red_wool white_wool cyan_wool blue_wool
        yellow_wool orange_wool black_wool""".split(),
    "building": """white_concrete light_gray_concrete quartz_block
        smooth_quartz smooth_sandstone white_terracotta""".split(),
    "gate": """iron_bars birch_fence oak_fence iron_door birch_door oak_door
        dark_oak_fence spruce_fence""".split(),
}
FAMILY_SYMBOLS = {"fabric": "F", "grass": "G", "leaves": "T", "bark": "T",
                  "wood": "T", "water": "W", "concrete": "B", "quartz": "B",
                  "gravel": "B", "brick": "B", "plaster": "B", "tiles": "B",
                  "roof": "B"}

# --- transparency, emission, shape ----------------------------------------
CUTOUT_FIRST_NAMES = "fire soul_fire nether_portal end_portal end_gateway".split()
MASKED_NAMES = """
glass_pane iron_bars ladder rail torch redstone_torch soul_torch redstone_wire
lever tripwire tripwire_hook lily_pad kelp seagrass tall_grass large_fern grass
vine scaffolding cobweb chest trapped_chest barrel bell candle end_rod chain
lantern brewing_stand flower_pot skeleton_skull wither_skeleton_skull
zombie_head player_head creeper_head dragon_head wall_sign oak_sign cake
pumpkin melon carved_pumpkin melon_stem attached_pumpkin_stem
attached_melon_stem nether_wart cobblestone_wall nether_bricks bone_block
hay_block
""".split()
MASKED_SUFFIXES = """
_leaves _sapling _vine _fern _door _trapdoor _fence _fence_gate _banner _carpet
_pressure_plate _button _rail _roots _coral _coral_fan _coral_block _wall_sign
_wall_torch _wall_banner _sign _stem _hyphae _fungus _candle _chain
""".split()
MASKED_TOKENS = """
leaves sapling vine door trapdoor fence banner carpet pressure_plate button
rail roots coral torch sign pane bars ladder plant bush flower
""".split()
TRANSPARENT_NAMES = """
glass water lava ice packed_ice blue_ice frosted_ice slime_block honey_block
barrier light structure_void spawner end_gateway beacon
""".split()
TRANSPARENT_SUFFIXES = "stained_glass stained_glass_pane".split()
TRANSPARENT_TOKENS = "glass _ice ice_".split()
EMISSIVE_COLOURS = {
    "lava": "#ff6a00", "glowstone": "#ffb463", "sea_lantern": "#ffdca0",
    "redstone_lamp": "#ff4d1a", "shroomlight": "#ffb45e", "end_rod": "#ffe6b0",
    "magma_block": "#8a3c10", "fire": "#ffb020", "beacon": "#8fd4ff",
    "soul_fire": "#3aa0ff", "crying_obsidian": "#8b3fd4",
}
EMISSIVE_SUFFIX = "_lantern"
EMISSIVE_SOUL, EMISSIVE_WARM = "#3aa8ff", "#ffb45e"
NON_CUBE_TOKENS = """
_slab _stairs _fence _fence_gate _wall _door _trapdoor _pane _pressure_plate
_button _rail _sign _banner _carpet _candle _sapling _plant _flower _bush
_leaves _chest _barrel _bed _torch _ladder _vine _grindstone _anvil _beacon
_conduit _lantern _scaffolding _barrier _chain _coral _roots _grass
""".split()

# --- map colours -----------------------------------------------------------
DYE_RGB = {
    "white": (249, 255, 254), "orange": (240, 118, 19),
    "magenta": (199, 78, 189), "light_blue": (58, 175, 217),
    "yellow": (254, 216, 61), "lime": (128, 199, 31), "pink": (243, 139, 170),
    "gray": (66, 70, 73), "light_gray": (157, 157, 151),
    "cyan": (21, 137, 145), "purple": (121, 42, 172), "blue": (53, 57, 157),
    "brown": (114, 71, 40), "green": (94, 124, 22), "red": (176, 46, 38),
    "black": (29, 29, 33),
}
DYED_SUFFIXES = \
    "_stained_glass_pane _stained_glass _concrete _wool _carpet".split()
LEAF_RGB = {"oak": (60, 143, 55), "birch": (100, 158, 86),
            "spruce": (42, 90, 54), "jungle": (48, 150, 29),
            "acacia": (119, 148, 42), "dark_oak": (48, 109, 42)}
LOG_RGB = {"oak": (109, 85, 50), "birch": (196, 180, 123),
           "spruce": (59, 38, 18), "jungle": (85, 67, 25),
           "acacia": (168, 90, 50), "dark_oak": (60, 46, 26)}
SPECIES_SUFFIXES = [("_leaves", "leaf"), ("_log", "log"), ("_wood", "log"),
                    ("_planks", "log")]
STRIPPED_SUFFIXES = """
_pressure_plate _wall_sign _trapdoor _stairs _slab _sign _fence _gate _door
_wall _button
""".split()

# name r g b
BLOCK_RGB = {row.split()[0]: tuple(int(v) for v in row.split()[1:]) for row in """
grass_block 127 178 56
grass 127 178 56
tall_grass 127 178 56
fern 94 124 22
large_fern 94 124 22
dirt 134 96 67
coarse_dirt 134 96 67
podzol 129 86 49
sand 219 207 163
sandstone 216 203 155
smooth_sandstone 216 203 155
smooth_sandstone_slab 216 203 155
smooth_sandstone_stairs 216 203 155
cobblestone 115 115 115
cobblestone_slab 115 115 115
stone 125 125 125
stone_slab 125 125 125
stone_stairs 125 125 125
stone_button 125 125 125
stone_pressure_plate 125 125 125
stone_bricks 122 122 122
stone_brick_slab 122 122 122
stone_brick_stairs 122 122 122
smooth_stone 158 158 158
smooth_stone_slab 158 158 158
bricks 150 97 83
brick_slab 150 97 83
brick_stairs 150 97 83
end_stone 219 222 158
end_stone_bricks 219 222 158
end_stone_brick_slab 219 222 158
end_stone_brick_stairs 219 222 158
quartz_block 235 229 222
quartz_slab 235 229 222
quartz_stairs 235 229 222
smooth_quartz 235 229 222
smooth_quartz_slab 235 229 222
smooth_quartz_stairs 235 229 222
chiseled_quartz_block 235 229 222
lapis_block 30 67 140
obsidian 21 18 30
prismarine_brick_slab 99 171 158
polished_granite_slab 149 103 85
diorite_wall 188 188 190
diorite_slab 188 188 190
polished_andesite_stairs 136 136 136
terracotta 152 94 67
pink_terracotta 161 83 78
red_nether_brick_stairs 44 22 26
red_nether_brick_slab 44 22 26
red_nether_brick_wall 44 22 26
crimson_fence 101 48 70
dark_oak_stairs 66 43 20
jungle_stairs 160 115 80
acacia_fence 168 90 50
composter 110 80 40
campfire 120 80 40
scaffolding 168 150 90
oak_sign 160 130 78
oak_wall_sign 160 130 78
spruce_trapdoor 59 38 18
birch_trapdoor 196 180 123
birch_slab 196 180 123
birch_stairs 196 180 123
iron_bars 140 142 140
iron_door 200 200 200
anvil 74 74 76
cauldron 70 70 72
lantern 150 120 60
diamond_block 92 219 213
lodestone 150 150 152
beacon 110 220 220
lever 110 110 110
dispenser 108 108 108
observer 90 90 90
heavy_weighted_pressure_plate 125 125 125
glass 200 220 230
glass_pane 200 220 230
cobweb 230 230 230
vine 50 110 40
shroomlight 250 160 80
spawner 30 40 35
tripwire 150 150 150
white_wall_banner 240 240 240
poppy 216 60 60
red_tulip 216 60 60
dandelion 255 236 40
azure_bluet 220 220 230
cornflower 70 90 200
oxeye_daisy 240 240 220
pink_tulip 243 139 170
white_tulip 249 255 254
orange_tulip 240 118 19
""".strip().splitlines()}
FAMILY_RGB = {
    "grass": (127, 178, 56), "path": (140, 120, 80), "soil": (134, 96, 67),
    "asphalt": (90, 90, 92), "concrete": (180, 180, 180),
    "plaster": (200, 196, 190), "brick": (150, 97, 83),
    "granite": (149, 103, 85), "tiles": (150, 120, 90), "roof": (110, 80, 70),
    "wood": (160, 130, 78), "bark": (109, 85, 50), "leaves": (60, 143, 55),
    "metal": (140, 142, 140), "gravel": (127, 124, 123),
    "rock": (110, 110, 112), "fabric": (200, 200, 200),
    "quartz": (235, 229, 222), "greystone": (127, 127, 127),
    "other": (150, 148, 144), "water": (58, 106, 128), "sports": (110, 190, 60),
}

# --- object recipes --------------------------------------------------------
# class: primitive, height cm, radius cm
RECIPES = {
    "tree": ("cone_on_cylinder", 900.0, 320.0),
    "plant": ("cross_billboard", 90.0, 25.0),
    "building": ("box", 500.0, 600.0),
    "structure": ("box", 260.0, 200.0),
    "prop": ("post", 140.0, 30.0),
    "unknown": ("box", 100.0, 50.0),
}
ASSET_EXTENSIONS = [".glb", ".gltf", ".fbx", ".obj"]
SECTION_SIZES = [7, 15, 31, 63, 127]

# --- placeholder colours ---------------------------------------------------
# name red green blue, 0..1
WORD_COLOURS = {r.split()[0]: tuple(float(v) for v in r.split()[1:]) for r in """
white 0.89 0.89 0.89
orange 0.95 0.55 0.16
magenta 0.86 0.35 0.79
light_blue 0.42 0.66 0.93
yellow 0.96 0.79 0.25
lime 0.55 0.82 0.24
pink 0.93 0.60 0.73
gray 0.42 0.42 0.42
light_gray 0.63 0.63 0.64
cyan 0.28 0.77 0.78
purple 0.51 0.32 0.71
blue 0.24 0.40 0.75
brown 0.53 0.35 0.22
green 0.36 0.62 0.22
red 0.70 0.24 0.22
black 0.16 0.16 0.17
""".strip().splitlines()}
DARKENED_TOKENS, DARKEN = ["terracotta", "concrete"], 0.94
NO_COLOUR = (0.55, 0.55, 0.58)
PLACEHOLDER_COLOURS = {r.split()[0]: tuple(float(v) for v in r.split()[1:]) for r in """
stone 0.51 0.51 0.53
granite 0.64 0.40 0.33
diorite 0.86 0.86 0.87
andesite 0.55 0.55 0.56
grass_block 0.42 0.66 0.28
dirt 0.53 0.38 0.25
coarse_dirt 0.51 0.37 0.25
podzol 0.42 0.31 0.18
cobblestone 0.48 0.48 0.49
bedrock 0.42 0.42 0.44
sand 0.91 0.86 0.65
red_sand 0.85 0.44 0.24
gravel 0.55 0.53 0.53
clay 0.62 0.66 0.70
netherrack 0.55 0.22 0.22
nether_bricks 0.24 0.13 0.14
end_stone 0.85 0.84 0.60
end_stone_bricks 0.83 0.82 0.58
obsidian 0.11 0.09 0.20
crying_obsidian 0.28 0.13 0.42
water 0.25 0.42 0.75
lava 0.85 0.35 0.05
ice 0.55 0.72 0.85
packed_ice 0.53 0.70 0.83
blue_ice 0.40 0.60 0.80
frosted_ice 0.65 0.80 0.90
snow_block 0.92 0.95 0.98
soul_sand 0.44 0.35 0.31
soul_soil 0.36 0.28 0.24
magma_block 0.42 0.20 0.11
glowstone 0.98 0.83 0.55
sea_lantern 0.85 0.92 0.88
shroomlight 0.96 0.65 0.30
redstone_lamp 0.75 0.24 0.12
netherite_block 0.32 0.28 0.27
quartz_block 0.92 0.90 0.87
smooth_sandstone 0.90 0.85 0.65
sandstone 0.87 0.80 0.58
prismarine 0.60 0.79 0.75
terracotta 0.66 0.40 0.31
brick 0.60 0.34 0.28
bookshelf 0.60 0.44 0.28
iron_block 0.78 0.78 0.80
gold_block 0.98 0.82 0.30
diamond_block 0.09 0.80 0.79
emerald_block 0.24 0.79 0.44
lapis_block 0.16 0.31 0.62
coal_block 0.10 0.10 0.10
obsidian_peak 0.11 0.09 0.20
basalt 0.35 0.33 0.34
blackstone 0.16 0.14 0.16
polished_blackstone 0.20 0.18 0.20
deepslate 0.24 0.24 0.26
tuff 0.44 0.42 0.39
calcite 0.90 0.89 0.85
dripstone_block 0.72 0.66 0.58
moss_block 0.30 0.42 0.22
sculk 0.12 0.20 0.22
mud 0.35 0.27 0.22
packed_mud 0.48 0.38 0.30
honey_block 0.90 0.66 0.20
slime_block 0.42 0.72 0.42
glass 0.80 0.88 0.88
white_stained_glass 0.90 0.93 0.93
oak_log 0.55 0.43 0.24
birch_log 0.83 0.79 0.68
spruce_log 0.35 0.25 0.14
jungle_log 0.53 0.40 0.24
acacia_log 0.55 0.35 0.24
dark_oak_log 0.35 0.25 0.14
oak_planks 0.68 0.56 0.36
oak_leaves 0.32 0.58 0.24
oak_sapling 0.36 0.62 0.26
coal_ore 0.42 0.42 0.42
iron_ore 0.72 0.65 0.58
gold_ore 0.78 0.68 0.42
diamond_ore 0.53 0.60 0.61
emerald_ore 0.44 0.57 0.48
lapis_ore 0.30 0.40 0.58
redstone_ore 0.55 0.22 0.20
gravel_placeholder 0.55 0.53 0.53
""".strip().splitlines()}

# --- graphics adapters: part of the name, in order ---------------------------
ADAPTER_HIGH = """
rtx 40;rtx 50;rtx 3090;rtx 3080;rtx 4070;rtx 4080;rtx 4090;rx 7900;rx 7800;rx 6800;arc a7
""".strip().split(";")
ADAPTER_MID = """
rtx 30;rtx 20;gtx 16;gtx 10;rx 6000;rx 5000;arc a5;arc a3;quadro rtx
""".strip().split(";")
ADAPTER_SHARED = """
iris xe;iris(r) xe;iris(tm) xe;iris plus;iris(tm) plus;uhd graphics 620;uhd graphics 630;uhd graphics 605;uhd graphics;hd graphics 520;hd graphics 550;hd graphics;vega 3;vega 6;vega 8;vega 11;vega graphics;radeon(tm) graphics;radeon graphics;apple m1;apple m2;microsoft basic;llvmpipe;swiftshader;basic render driver
""".strip().split(";")
ADAPTER_MAKERS = ["nvidia", "geforce", "quadro", "radeon rx"]
TIER_INDEX = (30.0, 120.0, 400.0)
